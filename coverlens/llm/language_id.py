"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of the lower-cased letters, weighted by term frequency (relative
to the text's n-grams) and inverse document frequency.  Weights are trained by
follow-the-regularised-leader with elastic-net penalties, which leaves most of them exactly
zero; a temperature fitted on texts apart from the training ones calibrates the scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coverlens.llm.common import free_prefix, quoted

ORDERS = (1, 2, 3)
#: Hashed features; all tables have this many rows, whatever the data.
FEATURES = 1 << 15
#: Bound of the labelled sample that the weights are fitted on: documents of one language, by hash of text.
SAMPLE_PER_LANG = 1500
MAX_LANGS = 500
#: Texts that weights are fitted on, over all languages.
SAMPLE_TOTAL = 100_000
EPOCHS = 2
UNDETERMINED = "und"
#: The pipeline rejects texts whose language is undetermined or less certain than this.
MIN_SCORE = 0.5
_PART = 256
_SPAN = 1 << 17


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # (FEATURES,)
    weights: np.ndarray  # (FEATURES, langs), mostly zero
    bias: np.ndarray
    temperature: float = 1.0


def learns(id_col: str = "doc_id") -> Column:
    """Documents that may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.coalesce(F.crc32(quoted(id_col).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def _char_codes() -> np.ndarray:
    """Table from code point to feature symbol: lower case for letters, 0 for all else."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


_codes: np.ndarray | None = None


def grams(text: str) -> Iterator[np.ndarray]:
    """Feature numbers of the text's n-grams, in spans of bounded length; non-letters become one blank.

    An n-gram holds a letter at least; runs of blanks count as one.
    """
    global _codes
    if _codes is None:
        _codes = _char_codes()
    tail = np.zeros(1, np.uint32)
    for at in range(0, len(text), _SPAN):
        last = at + _SPAN >= len(text)
        c = _codes[np.frombuffer(text[at:at + _SPAN].encode("utf-32-le", "surrogatepass"), np.uint32)]
        c = np.concatenate([tail, c, np.zeros(1, np.uint32)] if last else [tail, c])
        keep = np.ones(len(c), bool)
        keep[1:] = (c[1:] > 0) | (c[:-1] > 0)
        c = c[keep].astype(np.uint32)
        out, h = [], np.zeros(len(c), np.uint32)
        letter = np.zeros(len(c), bool)
        for n in range(1, max(ORDERS) + 1):
            m = len(c) - n + 1
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) + c[n - 1:] * np.uint32(0x9E3779B1) + np.uint32(n)
            letter = letter[:m] | (c[n - 1:] > 0)
            if n in ORDERS:
                mixed = (h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                # An n-gram that ends in what the next span repeats belongs to that span.
                begin = np.arange(m) + n > len(tail) if at else np.ones(m, bool)
                out.append(((mixed >> np.uint32(32 - 15)) & np.uint32(FEATURES - 1))[letter & begin].astype(np.int64))
        yield np.concatenate(out) if out else np.empty(0, np.int64)
        tail = c[-(max(ORDERS) - 1):]


def _frequencies(batches: Iterable) -> Iterator:
    """Mapper: texts -> (feature, number of texts that have it), and feature -1 for the number of texts."""
    import pyarrow as pa

    df = np.zeros(FEATURES + 1, np.int64)
    for batch in batches:
        for text in batch.column(0).to_pylist():
            df[-1] += 1
            seen = np.zeros(FEATURES, bool)
            for g in grams(text):
                seen[g] = True
            df[:-1] += seen
    f = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.where(f == FEATURES, -1, f), pa.int64()), pa.array(df[f], pa.int64())], ["f", "n"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """log((1 + n) / (1 + df)) + 1 for each feature, counted over all texts; one small table comes back."""
    got = texts.mapInArrow(_frequencies, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(FEATURES + 1, np.int64)
    df[got["f"].to_numpy()] = got["n"].to_numpy()
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of a text and their weights, scaled to unit length."""
    count = np.zeros(FEATURES)
    for g in grams(text):
        count += np.bincount(g, minlength=FEATURES)
    f = np.flatnonzero(count)
    v = count[f] * idf[f]
    return f, v / max(float(np.sqrt(v @ v)), 1e-300)


def train(rows: Sequence[tuple[str, int]], langs: list[str], idf: np.ndarray, epochs: int = EPOCHS, alpha: float = 0.5,
          beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, calibrate_every: int = 5) -> Model:
    """FTRL-proximal over (text, language number) rows; every ``calibrate_every``-th row sets the temperature only."""
    k = len(langs)
    vectors = [(*tfidf(t, idf), y) for t, y in rows]
    fit = [v for i, v in enumerate(vectors) if i % calibrate_every] or vectors
    held = vectors[::calibrate_every]
    z, n = np.zeros((FEATURES + 1, k)), np.zeros((FEATURES + 1, k))

    def solve(f: np.ndarray) -> np.ndarray:
        zf = z[f]
        w = -(zf - np.sign(zf) * l1) / ((beta + np.sqrt(n[f])) / alpha + l2)
        return np.where(np.abs(zf) <= l1, 0.0, w)

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        for i in order.permutation(len(fit)):
            f, v, y = fit[i]
            f, v = np.append(f, FEATURES), np.append(v, 1.0)
            w = solve(f)
            s = v @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[y] -= 1
            g = v[:, None] * p
            g2 = n[f] + g * g
            z[f] += g - (np.sqrt(g2) - np.sqrt(n[f])) / alpha * w
            n[f] = g2
    w = solve(np.arange(FEATURES + 1))
    model = Model(langs, idf, w[:-1], w[-1])
    logits = np.array([v @ model.weights[f] + model.bias for f, v, _ in held]).reshape(-1, k)
    model.temperature = fit_temperature(logits, np.array([y for *_, y in held], np.int64))
    return model


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least negative log likelihood, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        s = logits / math.exp(t)
        s = s - s.max(1, keepdims=True)
        return float((np.log(np.exp(s).sum(1)) - s[np.arange(len(y)), y]).mean())

    lo, hi, r = math.log(0.05), math.log(20.0), (math.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = hi - r * (hi - lo), lo + r * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return math.exp((lo + hi) / 2)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_per_lang: int = SAMPLE_PER_LANG, max_langs: int = MAX_LANGS, sample_total: int = SAMPLE_TOTAL) -> Model | None:
    """Learns from texts with a language whose id may be learned from; None if there are none.

    Document frequencies cover all of these; the weights are fitted on the distinct texts of a
    sample of about ``sample_per_lang`` documents of each language, chosen by a hash of the
    text, and of about ``sample_total`` in all.  At most ``max_langs`` languages are learnt, those
    with the most documents (ties by code point): one column of weights each is what a worker
    holds.  A column of many more values than that is not one of languages.
    """
    rows = (docs.filter(learns(id_col)).select(quoted(text_col).alias("text"), quoted(lang_col).alias("lang"))
            .filter(F.col("text").isNotNull() & F.col("lang").isNotNull()))
    counts = sorted((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
                    .orderBy(F.col("n").desc(), "lang").limit(max_langs).collect())
    if not counts:
        return None
    idf = inverse_frequencies(rows.select("text"))
    langs = [lang for lang, _ in counts]
    scale = 1 << 30
    chosen = F.pmod(F.xxhash64("text"), F.lit(scale))
    wanted = max(1, min(sample_per_lang, sample_total // len(counts)))
    limit = F.create_map(*[F.lit(x) for lang, n in counts for x in (lang, min(scale, math.ceil(scale * wanted / n)))])
    sample = rows.filter(chosen < F.coalesce(limit[F.col("lang")], F.lit(0))).dropDuplicates(["text", "lang"])
    number = {lang: i for i, lang in enumerate(langs)}
    schema = "langs array<string>, weights binary, bias binary, temperature double"

    def one(batches: Iterable) -> Iterator:
        import pyarrow as pa

        got = sorted((t, number[lang]) for b in batches for t, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        if got:
            shuffled = np.random.Generator(np.random.PCG64(11)).permutation(len(got))
            m = train([got[i] for i in shuffled], langs, idf)
            yield pa.RecordBatch.from_arrays(
                [pa.array([langs]), pa.array([m.weights.astype(np.float32).tobytes()]), pa.array([m.bias.tobytes()]),
                 pa.array([m.temperature])], ["langs", "weights", "bias", "temperature"])

    got = sample.repartition(1).mapInArrow(one, schema).first()
    return Model(langs, idf, np.frombuffer(got["weights"], np.float32).reshape(FEATURES, len(langs)),
                 np.frombuffer(got["bias"]), got["temperature"])


def _scorer(shared):
    def run(batches: Iterable) -> Iterator:
        import pyarrow as pa

        m = shared.value
        weighted = (m.weights * m.idf[:, None]).astype(np.float32)
        idf2 = m.idf * m.idf
        for batch in batches:
            lang, score = [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                total = np.zeros(FEATURES)
                for g in grams(text or ""):
                    total += np.bincount(g, minlength=FEATURES)
                norm = float(np.sqrt(total * total @ idf2))
                if not norm:
                    lang.append(UNDETERMINED)
                    score.append(0.0)
                    continue
                f = np.flatnonzero(total)
                s = ((total[f] / norm) @ weighted[f] + m.bias) / m.temperature
                p = np.exp(s - s.max())
                best = int(np.argmax(p))
                lang.append(m.langs[best])
                score.append(float(p[best] / p.sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64())],
                                             names=[*batch.schema.names[:-1], "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus lang_pred and score; only the text takes part in the prediction.

    A null text, or one without letters, is ``und`` with score 0; so is every text when there was
    nothing to learn from.  Equal scores go to the language that comes first by code point.
    Columns called like the results are replaced.  Texts of any length are read whole.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    if model is None:
        return docs.select(*[quoted(c) for c in keep], F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = free_prefix([*keep, "lang_pred", "score"], "text_to_score")
    rows = docs.select(*[quoted(c) for c in keep], quoted(text_col).alias(read))
    schema = rows.drop(read).withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(_scorer(shared), schema)


def accepted(docs: DataFrame, min_score: float = MIN_SCORE, **columns: str) -> DataFrame:
    """Documents whose language is recognised with at least ``min_score``; their own columns, unchanged.

    Without anything to learn from (no labelled document) nothing can be judged and all stay
    that have a letter at all.
    """
    text = columns.get("text_col", "text")
    mine = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    model = fit(docs, **columns)
    if model is None:
        return docs.filter(F.coalesce(quoted(text), F.lit("")).rlike(r"\p{L}"))
    plain = docs.select(*[quoted(c).alias(v) for c, v in mine.items()])
    col = next(v for c, v in mine.items() if c.lower() == text.lower())
    scored = predict(plain, model, col)
    return (scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score))
            .select(*[F.col(v).alias(c) for c, v in mine.items()]))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs.select("doc_id", "text"), fit(docs), keep=["doc_id"]).select(
        "doc_id", (~learns()).alias("held_out"), "lang_pred", "score")
