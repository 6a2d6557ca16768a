"""The final selection: top type priority, PDF only, no stop-word in the name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SelectionConfig
from ..functions.text import contains_any, matched_words, same_text
from ..sources.registry import Registry
from .joins import key_text
from .priority import (TIE_BREAK, output_columns, prioritised_documents, rank_documents,
                       rank_input, ranking_parts, registry_row_bound, top_priority_documents)


def final_filter(ranked: DataFrame, cfg: SelectionConfig):
    """Priority 1, file type pdf, and none of the stop-words in the name. A NULL name makes
    ``NOT LIKE`` UNKNOWN, so such rows are dropped."""
    cs = cfg.case_sensitive
    return ((F.col("DocumentTypePriorityOrdinal") == 1)
            & same_text(F.col("DocumentFileType"), cfg.selected_file_type, cs)
            & ~contains_any(F.col("DocumentName"), cfg.distinct_stop_words, cs))


def result_order():
    """Market reference descending (NULLs last, as the lowest value), rank, id, then the tie-break."""
    return [F.col("UniqueMarketRef").desc_nulls_last(), F.col("DocumentPriorityOrdinal").asc(),
            F.col("DocumentID").asc(), *[F.col(c).asc_nulls_first() for c in TIE_BREAK]]


def selected_documents(reg: Registry, cfg: SelectionConfig, *, ordered: bool = True,
                       prefilter: bool = True, strategy: str = "auto") -> DataFrame:
    """The flagship result: 24 columns, one row per selected document.

    The ranking runs over all eligible documents of priority 1 (``prefilter``; ranks are the
    same as over all eligible documents); the file-type and stop-word filters apply after it.
    """
    bound = registry_row_bound(reg, cfg) if strategy == "auto" else None
    rows = top_priority_documents(reg, cfg) if prefilter else prioritised_documents(reg, cfg)
    ranked = rank_documents(rank_input(rows), strategy=strategy, max_rows=bound,
                            **ranking_parts(reg, cfg, top_only=prefilter))
    out = output_columns(ranked.where(final_filter(ranked, cfg)))
    return out.orderBy(*result_order()) if ordered else out


def stopword_hits(reg: Registry, cfg: SelectionConfig) -> DataFrame:
    """Which stop-words each eligible document name contains, one row per (document, word)."""
    d = prioritised_documents(reg, cfg).select("DocumentID", "DocumentName")
    words = matched_words(F.col("DocumentName"), cfg.distinct_stop_words, cfg.case_sensitive)
    return d.select("DocumentID", "DocumentName", F.explode(words).alias("StopWord"))


def filter_by_reference(selected: DataFrame, references: DataFrame, cfg: SelectionConfig,
                        column: str = "UniqueMarketRef") -> DataFrame:
    """Dormant option: keep only documents whose market reference is in ``references``
    (a one-column DataFrame of references), as a left-semi join. References may repeat: without a
    ``distinct`` both sides have a plain exchange, which adaptive execution splits on a hot key."""
    cs = cfg.case_sensitive
    refs = references.select(key_text(F.col(references.columns[0]), cs).alias("_ref"))
    s = selected.withColumn("_ref", key_text(F.col(column), cs))
    return s.join(refs, "_ref", "left_semi").drop("_ref")


def registry_union(selections: list[DataFrame], sources: list[str]) -> DataFrame:
    """Append the selections of several registries, aligned by column name, tagged by source."""
    tagged = [s.withColumn("Source", F.lit(src)) for s, src in zip(selections, sources)]
    out = tagged[0]
    for t in tagged[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
