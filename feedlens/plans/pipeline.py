"""The enrichment chain and the end-to-end job."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens.functions.text import dataset_name
from feedlens.operators.filters import min_length, non_empty
from feedlens.operators.review import review_export
from feedlens.operators.totals import StageTotals
from feedlens.session import cut_lineage, job_scratch
from feedlens.sources.raw import InputCheck, read_messages
from feedlens.sources.reviewset import write_review_set
from feedlens.sources.store import MessageStore

log = logging.getLogger(__name__)

Step = Callable[[DataFrame], DataFrame]

STAGES = ("translate", "classify", "geolocate", "anonymize")


def enrich(
    messages: DataFrame,
    translate: Step | None = None,
    classify: Step | None = None,
    geolocate: Step | None = None,
    anonymize: Step | None = None,
    totals: StageTotals | None = None,
) -> DataFrame:
    """The stages that are given, always in this order. Nothing runs before an action.

    With ``totals`` the rows that leave each stage are counted by that action.
    """
    for name, step in zip(STAGES, (translate, classify, geolocate, anonymize)):
        if step is not None:
            messages = messages.transform(step)
            if totals is not None:
                messages = totals.watch(messages, name)
    return messages


@dataclass
class Pipeline:
    """Messages from a source or a store, enriched, and saved back."""

    store: MessageStore
    extract: Callable[[], DataFrame] | None = None
    stages: dict[str, Step] = field(default_factory=dict)
    messages: DataFrame | None = None

    def __post_init__(self) -> None:
        unknown = set(self.stages) - set(STAGES)
        if unknown:
            raise ValueError(f"unknown stage {', '.join(sorted(unknown))}; stages are {', '.join(STAGES)}")

    def set_messages(self, messages: DataFrame) -> Pipeline:
        self.messages = messages
        return self

    def run(self, extract: bool = True, transform: bool = True, save_output: bool = True, **filters) -> DataFrame:
        """``filters`` (start, end, country, source) apply when messages are loaded from the store."""
        if extract:
            if self.extract is None:
                raise ValueError("no source to extract from")
            self.messages = self.extract()
        elif self.messages is None:
            self.messages = self.store.read(**filters)
        if transform:
            self.messages = enrich(self.messages, **self.stages)
        if save_output:
            self.messages = cut_lineage(self.messages)
            self.store.upsert(self.messages)
        return self.messages


def run_listening(
    spark: SparkSession,
    source: str,
    path: str,
    country: str,
    as_of: str,
    scraped_at: str,
    store: MessageStore,
    review_path: str,
    keywords: DataFrame | list[str],
    stages: dict[str, Step] | None = None,
    days: int = 14,
    minimum: int = 20,
    max_malformed: float = 1.0,
    **source_options,
) -> dict[str, str | int | dict[str, int]]:
    """Landed exports of the last ``days`` days to the store and to a review set.

    The review set is made from the stored rows of the same window, so the
    enrichment is computed once. Rows are counted at every stage while it runs.
    Nothing is stored if more than the share ``max_malformed`` of the landed
    records is malformed; by default they are only counted.
    """
    country = country.upper()
    first, last = spark.sql(
        "SELECT CAST(date_sub(DATE(:d), :n) AS STRING), CAST(DATE(:d) AS STRING)", {"d": as_of, "n": days}
    ).first()
    totals, check = StageTotals(), InputCheck(max_malformed)
    name = f"{country}-{first}-{last}"
    with job_scratch(spark):
        messages = read_messages(spark, source, path, first, country, scraped_at, check=check, **source_options)
        extracted = totals.watch(messages, "extract")
        kept = totals.watch(min_length(non_empty(extracted), minimum), "filter")
        # the upsert looks at its batch twice; engines must not run twice for that
        ready = cut_lineage(totals.watch(enrich(kept, **(stages or {}), totals=totals), "processed"))
        landed = check.refuse()
        counts = totals.counts()
        log.info("%s of %s landed records malformed; rows by stage: %s", landed["malformed"], landed["records"], counts)
        store.upsert(ready)
        stamped = F.col("datetime_scraped_") == F.lit(scraped_at).cast("timestamp_ntz")
        saved = store.read(start=first, country=country).where(stamped)
        write_review_set(review_export(saved, keywords, name, country), review_path)
    return {
        "country": country,
        "dataset": name,
        "start": first,
        "end": last,
        "processed": counts["processed"],
        "landed": landed["records"],
        "malformed": landed["malformed"],
        "stages": counts,
    }


def dataset_column(start: str, end: str):
    """Data-set name per message: country and the two days."""
    return dataset_name(
        F.col("country"), F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    )
