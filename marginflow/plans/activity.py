"""Client activity at three levels from one pass over the operational model:
active days and campaigns per client x platform x window x month, per client x
platform x window, and per client."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginflow.operators.aggregates import month_start
from marginflow.operators.bitmaps import bit_words, count_words, merge_words, numbered, text_word, word_of
from marginflow.plans.context import Workspace
from marginflow.plans.operational import unified_ad_metrics
from marginflow.sources.sinks import materialize

LEVELS = {
    "month": ["client_id", "platform", "attribution_window", "cohort_month"],
    "channel": ["client_id", "platform", "attribution_window"],
    "client": ["client_id"],
}
COLUMNS = ["client_id", "platform", "attribution_window", "cohort_month"]
COUNTS = {"n_report_days": ["day"], "num_campaigns": ["campaign", "unknown campaign"]}


def activity_facts(ws: Workspace) -> DataFrame:
    """The keys of the operational model's rows, with the campaign's number.
    Sets don't count a row twice, so nothing is summed, and the client lookup,
    which keeps every row, is left out."""
    masters = ws.cl("campaigns")
    positions = materialize(ws.spark, numbered(masters, "campaign_id", ["account_id"]), "campaign-positions")
    if any(ws.stored(f"model:{m}") for m in ("unified_ad_metrics", "unified_sums")):
        facts = unified_ad_metrics(ws).select("client_id", "platform", "attribution_window", "report_date", "campaign_id")
        return facts.join(positions, "campaign_id", "left")
    facts = ws.cl("ad_metrics").select("campaign_id", "client_id", "report_date", "attribution_window")
    lookup = masters.select("campaign_id", "platform").join(positions, "campaign_id")
    return ws.dealt(facts, "campaign_id", "activity-facts", placed=True).join(lookup, "campaign_id", "left")


def activity_words(ws: Workspace) -> DataFrame:
    """Words of the finest level: days by number, campaigns by their number in
    the campaign master (ordered by account, so a client's campaigns share
    words); a campaign that the master lacks is a word of its own."""
    facts = (ws.dealt(activity_facts(ws), "client_id", "activity-facts")
             .withColumn("cohort_month", month_start("report_date")))
    slot, word = text_word(F.col("campaign_id"))
    return bit_words(facts, LEVELS["month"], {
        "day": word_of(F.unix_date("report_date")),
        "campaign": word_of(F.col("position")),
        "unknown campaign": (slot, F.when(F.col("position").isNull(), word))})


def client_activity(ws: Workspace) -> DataFrame:
    """(level, client_id, platform, attribution_window, cohort_month,
    n_report_days, num_campaigns); columns beyond the level's keys are NULL.

    The words of the finest level are written; each level merges the words of
    the one before, so the facts are read once.  A group without any day or
    campaign (all NULL) has no word and no row.
    """
    words = activity_words(ws)
    words = ws.dealt(words, "client_id", "activity-words", keep=True, placed=True) if ws.dealing else materialize(ws.spark, words, "activity-words")
    out = None
    for level, keys in LEVELS.items():
        words = merge_words(words, keys) if level != "month" else words
        counted = count_words(words, keys, COUNTS)
        types = dict(words.dtypes) | {"cohort_month": "date", "platform": "string", "attribution_window": "string"}
        row = counted.select(F.lit(level).alias("level"),
                             *[F.col(c) if c in keys else F.lit(None).cast(types[c]).alias(c) for c in COLUMNS], *COUNTS)
        out = row if out is None else out.unionByName(row)
    return out
