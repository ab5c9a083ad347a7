"""A ladder of attempts for sources that can't be read at once: direct, again after a wait, by browser, by other addresses.

All open sources take one step in each round, as one Spark job; a row carries its own log, so no round needs a shuffle, and
what is done leaves the rounds. There are as many rounds as the longest ladder: tries, browser, other addresses.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank
from .gates import fetch_failure
from .graph import Steps

#: Waits before the second and third try, in milliseconds (fixed values).
DELAYS_MS = (1500, 4000)
ATTEMPT = "struct<method:string,ok:boolean,status:int,duration_ms:long,error:string>"


def recovered(sources: DataFrame, attempt: Callable[[DataFrame], DataFrame], tries: int = 3, delays_ms: tuple[int, ...] = DELAYS_MS, browser: bool = True, jitter: Column | None = None, url: str = "url", alternates: str = "alternate_urls") -> DataFrame:
    """sources with recovery_status (ok, recovered, failed), recovery_method, html, final_url, final_error, waited_ms and attempts.

    attempt adds ok, status, kind, error, html, final_url and duration_ms to rows with attempt_method (direct, retry, browser,
    alternate), attempt_url, attempt_number (from 1) and wait_ms (to be waited before it); its columns may be null, and it keeps
    every row once. An attempt counts as ok only with a status from 200 to 399 and text that isn't blank.

    A direct attempt is repeated while its failure may pass, `tries` times in all. Then, unless it is final (a login, a
    captcha), the browser; then each other address in order. The error is the last attempt's. jitter is added to each wait; by
    default it is up to 350 ms and depends on the address. No other addresses, null ones and an empty table are fine; names of the result must not be columns of the sources.
    """
    names = sources.columns
    wait = F.pmod(F.xxhash64(F.col(url), F.col("attempt_number")), F.lit(350)) if jitter is None else jitter
    others = F.coalesce(F.col(alternates), F.array().cast("array<string>"))
    start = {"attempt_method": F.lit("direct"), "attempt_url": F.col(url), "attempt_number": F.lit(1), "wait_ms": F.lit(0).cast("long"), "waited_ms": F.lit(0).cast("long"), "_other": F.lit(0), "attempts": F.array().cast(f"array<{ATTEMPT}>")}
    state = [*start]
    done, open_ = [], sources.withColumns(start)
    with Steps(sources.sparkSession) as steps:
        while True:
            seen = attempt(open_)
            code, text = F.coalesce(F.col("status").cast("int"), F.lit(0)), F.coalesce(F.col("html"), F.lit(""))
            ok = F.coalesce(F.col("ok"), F.lit(False)) & code.between(200, 399) & (F.trim(F.regexp_replace(text, r"\s+", " ")) != "")
            kind = F.coalesce(F.nullif(F.col("kind"), F.lit("")), F.when(code != 0, "http").otherwise("network"))
            out = seen.withColumns({"status": code, "html": F.when(ok, text).otherwise(""), "_ok": ok, "_failure": fetch_failure(code, kind, "error")})
            why = F.when(F.col("_ok"), "").otherwise(F.coalesce(F.nullif(blank("error"), F.lit("")), F.col("_failure.reason")))
            log = F.struct(F.col("attempt_method").alias("method"), F.col("_ok").alias("ok"), "status", F.greatest(F.lit(0), F.coalesce(F.col("duration_ms"), F.lit(0))).cast("long").alias("duration_ms"), why.alias("error")).cast(ATTEMPT)
            direct = F.col("attempt_method").isin("direct", "retry")
            again = direct & F.col("_failure.retryable") & (F.col("attempt_number") < max(1, tries))
            step = F.when(F.col("_ok"), None).when(again, "retry").when(direct & ~F.col("_failure.terminal") & F.lit(browser), "browser").when(F.col("_other") < F.size(others), "alternate")
            kept = out.withColumns({"attempts": F.concat("attempts", F.array(log)), "_next": step, "_error": why}).select(*names, *state, "html", "final_url", "_ok", "_error", "_next")
            table = steps.keep(kept)
            done.append(table.where("_next is null"))
            left = table.where("_next is not null")
            if left.isEmpty():
                break
            delay = F.when(F.col("_next") == "retry", F.greatest(F.lit(0), F.get(F.array(*(F.lit(d) for d in delays_ms or (0,))), F.least(F.col("attempt_number"), F.lit(max(1, len(delays_ms)))) - 1) + wait)).otherwise(0).cast("long")
            on = F.col("_next") == "alternate"
            moved = left.select(*names, F.col("_next").alias("attempt_method"), F.when(on, F.get(others, F.col("_other"))).otherwise(F.col(url)).alias("attempt_url"), (F.col("attempt_number") + 1).alias("attempt_number"), delay.alias("wait_ms"), (F.col("waited_ms") + delay).alias("waited_ms"), (F.col("_other") + on.cast("int")).alias("_other"), "attempts")
            open_ = moved.select(*names, *state)
        all_ = reduce(DataFrame.unionByName, done)
        status = F.when(~F.col("_ok"), "failed").when(F.col("attempt_method") == "direct", "ok").otherwise("recovered")
        found = F.when(F.col("_ok"), F.coalesce(F.nullif(F.col("final_url"), F.lit("")), F.col(url))).otherwise("")
        return steps.result(all_.select(*names, status.alias("recovery_status"), F.when(F.col("_ok"), F.col("attempt_method")).otherwise("").alias("recovery_method"), "html", found.alias("final_url"), F.when(F.col("_ok"), "").otherwise(F.col("_error")).alias("final_error"), "waited_ms", "attempts"))
