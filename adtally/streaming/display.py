"""Display metrics on streams: the totals (update mode) and the changelog.

* ``display_metrics_stream`` is an update-mode aggregate; its updates are a log
  with a partition per micro-batch (``sinks.files``).
* ``changelog_stream`` gives every event its display's totals of the earlier
  micro-batches from the state store; ``changelog_rows`` adds the running counts
  inside the micro-batch by the batch plan and keeps one row per impression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLICK, DEFAULT_RULES, IMPRESSION, Rules
from ..functions.columns import require_keys
from ..plans.display_metrics import display_metrics_changelog
from ..schemas import DISPLAY_KEY
from .carry import carried, carry


def _display_events(imp: DataFrame, clk: DataFrame) -> DataFrame:
    ev = require_keys(imp.unionByName(clk), ["partner_id", "group_id", "display_target"])
    return ev.withColumn("display_id", F.coalesce(F.col("display_id"), F.lit("")))


def display_metrics_stream(imp: DataFrame, clk: DataFrame) -> DataFrame:
    """Streaming Q3 (update mode): running counts of displays with impressions."""
    # ``emitted_at``: when the update was produced (the reference stamps its
    # rows with the wall clock); evaluated once per micro-batch.
    return (_display_events(imp, clk).groupBy(*DISPLAY_KEY)
            .agg(F.count_if(F.col("kind") == IMPRESSION).alias("impression_count"),
                 F.count_if(F.col("kind") == CLICK).alias("click_count"))
            .where(F.col("impression_count") > 0).withColumn("emitted_at", F.current_timestamp()))


def changelog_stream(imp: DataFrame, clk: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The events the changelog is made of, each with its display's totals of
    the micro-batches before (``_imps``, ``_clks``)."""
    ev = _display_events(imp, clk).select(*DISPLAY_KEY, "kind", *dict.fromkeys(["ts", *rules.order]))
    return carry(ev, DISPLAY_KEY, {"_imps": ("sum", (F.col("kind") == IMPRESSION)), "_clks": ("sum", (F.col("kind") == CLICK))})


def changelog_rows(batch: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """A micro-batch of ``changelog_stream`` as changelog rows: one per
    impression with the display's impressions so far and the clicks before it,
    in the order of ``rules`` inside the micro-batch, of arrival across them."""
    log = display_metrics_changelog(batch, rules, keep=("_imps", "_clks"))
    rest = [c for c in log.columns if c not in ("impression_count", "click_count", "_imps", "_clks")]
    return log.select(*rest, (F.col("impression_count") + carried("_imps")).alias("impression_count"),
                      (F.col("click_count") + carried("_clks")).alias("click_count"))
