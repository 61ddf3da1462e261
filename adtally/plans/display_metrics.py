"""Q3 — display metrics: impressions and clicks per
(partner, group, display target, display id), over all time.

The reference emits a row each time a display's impression count changes,
looking up the click count *at that moment*; clicks after a display's last
impression never show, and displays with clicks only never appear. Three
views are offered:

* ``display_metrics`` — complete totals for every display with impressions;
* ``display_metrics_changelog`` — the exact update stream: one row per
  impression with the running impression count and the clicks so far;
* ``display_metrics_asof`` — the last row of that stream per display.

A null display id is reported as the empty string. Rows without partner,
group or display target go to the dead letter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import CLICK, DEFAULT_RULES, IMPRESSION, Rules
from ..functions.columns import require_keys
from ..operators.counts import total_count
from ..operators.running import running_sums
from ..schemas import DISPLAY_KEY, DISPLAY_METRICS_COLUMNS
from ..sources.tables import clicks as only_clicks
from ..sources.tables import impressions as only_impressions

# Length of the time slices that split one display's history for the
# running counts of the changelog.
CHANGELOG_SLICE = "1 minute"


def _keyed(ad: DataFrame) -> DataFrame:
    ad = require_keys(ad, ["partner_id", "group_id", "display_target"])
    return ad.withColumn("display_id", F.coalesce(F.col("display_id"), F.lit("")))


def display_impressions_total(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-7."""
    return total_count(only_impressions(_keyed(ad)), DISPLAY_KEY, "impression_count")


def display_clicks_total(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-8."""
    return total_count(only_clicks(_keyed(ad)), DISPLAY_KEY, "click_count")


def display_metrics(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Totals for displays with at least one impression: one aggregate over
    both kinds (one exchange)."""
    out = (_keyed(ad).groupBy(*DISPLAY_KEY)
           .agg(F.count_if(F.col("kind") == IMPRESSION).alias("impression_count"),
                F.count_if(F.col("kind") == CLICK).alias("click_count")))
    return out.where(F.col("impression_count") > 0).select(*DISPLAY_METRICS_COLUMNS)


def display_metrics_changelog(ad: DataFrame, rules: Rules = DEFAULT_RULES,
                              slice_duration: str = CHANGELOG_SLICE, keep: tuple[str, ...] = ()) -> DataFrame:
    """JN-3: one row per impression, with the display's impression count
    including it and the clicks strictly before it (order ``rules.order``).
    ``keep`` names further columns of ``ad`` to carry.
    """
    ev = _keyed(ad).withColumn("_slice", F.window("ts", slice_duration).start)
    run = running_sums(
        ev, DISPLAY_KEY, "_slice", rules.order,
        {"impression_count": (F.col("kind") == IMPRESSION).cast("long"),
         "click_count": (F.col("kind") == CLICK).cast("long")},
    )
    return (run.where(F.col("kind") == IMPRESSION)
               .select(*DISPLAY_KEY, *[o for o in rules.order if o != "ts"], F.col("ts").cast("timestamp_ntz").alias("ts"),
                       *keep, "impression_count", "click_count"))


def display_metrics_asof(ad: DataFrame, rules: Rules = DEFAULT_RULES,
                         slice_duration: str = CHANGELOG_SLICE) -> DataFrame:
    """Last changelog row per display: what a consumer of the update stream
    ends up with (clicks after the last impression are missing).

    Counts and the last impression's place per (display, time slice) come from
    one partial aggregate; per display, the slices before its last impression
    count in full, and only the clicks inside that one slice are looked at row
    by row."""
    ev = _keyed(ad).withColumn("_slice", F.window("ts", slice_duration).start)
    place = F.struct(*[F.col(o) for o in rules.order])
    is_imp, is_click = F.col("kind") == IMPRESSION, F.col("kind") == CLICK
    slices = ev.groupBy(*DISPLAY_KEY, "_slice").agg(F.count_if(is_imp).alias("_i"), F.count_if(is_click).alias("_c"),
                                                    F.max(F.when(is_imp, place)).alias("_at"))
    # all slices of a display, folded: totals up to the last slice with an impression
    upto = Window.partitionBy(*DISPLAY_KEY).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    last = (slices.withColumn("_before", F.coalesce(F.sum("_c").over(upto), F.lit(0)))
            .withColumn("_imps", F.coalesce(F.sum("_i").over(upto), F.lit(0)) + F.col("_i"))
            .where(F.col("_i") > 0).groupBy(*DISPLAY_KEY)
            .agg(F.max_by(F.struct("_slice", "_at", "_imps", "_before"), "_slice").alias("_l"))
            .select(*DISPLAY_KEY, "_l.*"))
    clk = ev.where(is_click).select(*DISPLAY_KEY, "_slice", place.alias("_p"))
    tail = (clk.join(last.select(*DISPLAY_KEY, "_slice", "_at"), [*DISPLAY_KEY, "_slice"])
            .where(F.col("_p") < F.col("_at")).groupBy(*DISPLAY_KEY).agg(F.count(F.lit(1)).alias("_in")))
    return (last.join(tail, list(DISPLAY_KEY), "left")
                .select(*DISPLAY_KEY, F.col("_imps").alias("impression_count"),
                        (F.col("_before") + F.coalesce("_in", F.lit(0))).alias("click_count")))
