"""Attempt outcomes of the collector, as data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the reference's retry rules ---------------------------------
MAX_RETRIES = 3
AUTH_STATUSES = (401, 403)
RATE_LIMIT_STATUS = 429
OK_STATUS = 200
TOKEN_WORDS = ("token", "unauthorized")
MAX_CONSECUTIVE_FAILURES = 10
REQUEST_DELAY_SEC = 0.4
RETRY_DELAY_TENTHS = 20
RATE_LIMIT_DELAY_TENTHS = 40
# -----------------------------------------------------------------------------------


def attempt_kind(status: Column, body: Column, error: Column) -> Column:
    """What an attempt met: ok, auth (401, 403), limit (429), token (another status whose body has a token word), other,
    timeout, denied (an error that says unauthorized) or broken."""
    low_body, low_err = F.lower(F.coalesce(body, F.lit(""))), F.lower(F.coalesce(error, F.lit("")))
    token = reduce(lambda a, b: a | b, [low_body.contains(w) for w in TOKEN_WORDS])
    return (F.when(status == OK_STATUS, "ok").when(status.isin(*AUTH_STATUSES), "auth").when(status == RATE_LIMIT_STATUS, "limit")
            .when(status.isNotNull(), F.when(token, "token").otherwise("other"))
            .when(low_err.contains("timeout"), "timeout").when(low_err.contains("unauthorized"), "denied").otherwise("broken"))


def chain_sql(attempts: str, max_retries: int = MAX_RETRIES) -> str:
    """SQL that folds a request's attempts, an array of (n, kind, refresh_ok) in order, into how the request went (T5).

    The fold carries whether the token was refreshed and ends at the first attempt that settles
    the request: ``ok``; an auth error after a refresh; an auth error whose refresh fails.
    Attempts recorded after that were not made and do not count.  A token word, a timeout of
    the first attempt and an unauthorized error also ask for a refresh, but only once one
    succeeds does the next attempt follow at once; else the request waits and goes on.  The
    result has outcome (``ok``, ``failed``, ``open`` if the attempts end early), attempts,
    refreshes, waited (tenths of a second) and the actions taken.
    """
    asks = "(NOT s.refreshed AND (x.kind IN ('auth', 'token', 'denied') OR x.kind = 'timeout' AND x.n = 1))"
    works = f"({asks} AND coalesce(x.refresh_ok, true))"
    action = (f"CASE WHEN x.kind = 'ok' THEN 'ok' WHEN {works} THEN 'refresh_retry' WHEN x.kind = 'auth' THEN if(s.refreshed, 'fail', 'refresh_failed') "
              "WHEN x.kind = 'limit' THEN 'backoff_retry' ELSE 'retry' END")
    ends = f"(x.kind = 'ok' OR x.kind = 'auth' AND NOT {works})"
    wait = (f"CASE WHEN {ends} OR {works} THEN 0 WHEN x.kind = 'limit' THEN {RATE_LIMIT_DELAY_TENTHS} "
            f"WHEN x.n < {max_retries} THEN {RETRY_DELAY_TENTHS} ELSE 0 END")
    step = (f"named_struct('outcome', CASE WHEN x.kind = 'ok' THEN 'ok' WHEN {ends} OR x.n >= {max_retries} THEN 'failed' ELSE 'open' END, "
            f"'refreshed', s.refreshed OR {works}, 'attempts', s.attempts + 1L, 'refreshes', s.refreshes + if({works}, 1L, 0L), "
            f"'waited', s.waited + CAST({wait} AS BIGINT), 'actions', concat(s.actions, array({action})), 'settled', {ends} OR x.n >= {max_retries})")
    start = ("named_struct('outcome', 'open', 'refreshed', false, 'attempts', 0L, 'refreshes', 0L, 'waited', 0L, "
             "'actions', CAST(array() AS ARRAY<STRING>), 'settled', false)")
    return f"aggregate({attempts}, {start}, (s, x) -> if(s.settled, s, {step}))"


def attempt_action(status: Column, body: Column, error: Column, attempt_no: Column,
                   refreshed: Column, max_retries: int = MAX_RETRIES, refresh_ok: Column | None = None) -> Column:
    """What the collector does after one attempt.

    ``ok`` (200), ``refresh_retry`` (401/403 before a refresh, a token word in an
    error body, a first-attempt timeout, an auth-like connection error), ``backoff_retry``
    (429), ``retry`` (anything else), ``fail`` (auth error after a refresh).  Any retry
    on the last attempt ends the request as ``give_up``.  ``refresh_ok`` says whether the refresh
    that the attempt asks for succeeds (unknown: yes): after an auth error a failed one ends the
    request as ``fail``, else the request is retried without.  ``chain_sql`` follows whole requests.
    """
    if refresh_ok is not None:
        works = F.coalesce(refresh_ok, F.lit(True))
        first = attempt_action(status, body, error, attempt_no, refreshed, max_retries)
        auth = status.isin(*AUTH_STATUSES)
        asks = attempt_action(status, body, error, F.lit(1), refreshed, 2) == "refresh_retry"
        asks = asks & ((attempt_no == 1) | status.isNotNull() | ~F.lower(F.coalesce(error, F.lit(""))).contains("timeout"))
        return (F.when(asks & ~works & F.coalesce(auth, F.lit(False)), F.lit("fail"))
                .when(asks & ~works & (attempt_no < max_retries), F.lit("retry")).otherwise(first))
    refreshed = F.coalesce(refreshed, F.lit(False))
    low_body = F.lower(F.coalesce(body, F.lit("")))
    low_err = F.lower(F.coalesce(error, F.lit("")))
    mentions_token = F.lit(False)
    for w in TOKEN_WORDS:
        mentions_token = mentions_token | low_body.contains(w)
    action = (
        F.when(status == OK_STATUS, F.lit("ok"))
        .when(status.isin(*AUTH_STATUSES), F.when(refreshed, F.lit("fail")).otherwise(F.lit("refresh_retry")))
        .when(status == RATE_LIMIT_STATUS, F.lit("backoff_retry"))
        .when(status.isNotNull(),
              F.when(mentions_token & ~refreshed, F.lit("refresh_retry")).otherwise(F.lit("retry")))
        .when(low_err.contains("timeout"),
              F.when((attempt_no == 1) & ~refreshed, F.lit("refresh_retry")).otherwise(F.lit("retry")))
        .otherwise(F.when(low_err.contains("unauthorized") & ~refreshed, F.lit("refresh_retry"))
                   .otherwise(F.lit("retry")))
    )
    return (F.when(action.endswith("retry") & (attempt_no >= max_retries), F.lit("give_up"))
            .otherwise(action))


def response_status(body: Column, pharmacies_json_path: str = "$.pharmacies") -> Column:
    """``failed`` for no/empty/invalid response, ``empty`` when it lists no pharmacy, else ``ok``."""
    keys = F.json_object_keys(body)
    n = F.json_array_length(F.get_json_object(body, pharmacies_json_path))
    return (F.when(body.isNull() | keys.isNull() | (F.size(keys) == 0), F.lit("failed"))
            .when(F.coalesce(n, F.lit(0)) == 0, F.lit("empty"))
            .otherwise(F.lit("ok")))
