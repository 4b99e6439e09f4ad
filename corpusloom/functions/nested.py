"""Nested records as Column expressions: timelines (arrays of turns), transcripts, token counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.text import clip

#: The token counters that are kept of a usage report.
COUNTERS = (
    "completion_tokens",
    "prompt_tokens",
    "total_tokens",
    "prompt_cache_hit_tokens",
    "prompt_cache_miss_tokens",
    "reasoning_tokens",
)


def timeline(text: Column, speaker: Column) -> Column:
    """The lines of ``text`` as turns (turn from 0, speaker, utterance); null without a text."""
    return F.transform(
        F.split(text, "\n"), lambda x, i: F.struct(i.cast("bigint").alias("turn"), speaker.alias("speaker"), x.alias("utterance"))
    )


def transcript(turns: Column) -> Column:
    """(speaker, text) of each turn."""
    return F.transform(turns, lambda x: F.struct(x["speaker"].alias("speaker"), x["utterance"].alias("text")))


def timeline_digest(turns: Column) -> Column:
    """SHA-256 of the turns, in order, a line of tab-separated fields each; to be stored with a record and compared."""
    line = lambda x: F.concat_ws("\t", x["turn"].cast("string"), x["speaker"], x["utterance"])
    return F.sha2(F.array_join(F.transform(turns, line), "\n"), 256)


def bounded(values: Column, k: int, n: int) -> Column:
    """The last ``k`` strings of an array, each clipped to ``n`` code points."""
    size = F.size(values)
    kept = F.when(size > k, F.slice(values, F.greatest(size - k + 1, F.lit(1)), k)).otherwise(values)
    return F.transform(kept, lambda x: clip(x, n))


def usage(report: Column) -> Column:
    """The token counters of a JSON usage report; reasoning tokens may stand one level down."""
    fields = ", ".join(f"{c} bigint" for c in COUNTERS)
    read = F.from_json(report, f"{fields}, completion_tokens_details struct<reasoning_tokens: bigint>")
    lifted = F.coalesce(read["reasoning_tokens"], read["completion_tokens_details"]["reasoning_tokens"])
    return F.struct(*(read[c].alias(c) for c in COUNTERS[:-1]), lifted.alias(COUNTERS[-1]))


def unnest_stages(rows: DataFrame, keys: list[str], stages: list[str]) -> DataFrame:
    """(keys, stage, fields) of the structs in the arrays ``stages``, which have the same fields: one pass over ``rows``."""
    labelled = F.array(*(F.struct(F.lit(s).alias("stage"), F.col(s).alias("turns")) for s in stages))
    return rows.select(*keys, F.inline(labelled)).select(*keys, "stage", F.inline("turns"))
