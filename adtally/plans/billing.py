"""Q1 — partner billing.

Per partner and 1-minute window: the billable amount and the fraudulent
amount, where a click is fraudulent if it is past the 10th click on the same
(partner, display target, display id, product) in that minute.
``total_billing_amount`` equals ``aggregated_amount`` (fraud is excluded
from billing).

Plan: two exchanges. The fold's top-10 side shuffles at most 10 rows per
placement-minute per map task; the final aggregate shuffles partial sums per
(partner, minute). Raw clicks never cross the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, Rules
from ..functions.columns import output_window, require_keys
from ..operators.fraud import click_fold, click_fold_rollup, tag_fraud
from ..schemas import BILLING_FRAUD_KEY, PARTNER_BILLING_COLUMNS
from ..sources.tables import clicks as only_clicks


def click_aggregation_1min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-3: fold per placement key and minute."""
    c = require_keys(only_clicks(ad), ["partner_id", "ts"])
    out = click_fold(c, BILLING_FRAUD_KEY, rules.billing_window, rules.fraud_limit, rules.order)
    return output_window(out)


def click_fraud_tagged(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """FLT-2: every click with its placement-minute and ``is_fraud``."""
    c = require_keys(only_clicks(ad), ["partner_id", "ts"])
    out = tag_fraud(c, BILLING_FRAUD_KEY, rules.billing_window, rules.fraud_limit, rules.order)
    return output_window(out.select("event_id", *BILLING_FRAUD_KEY, "amount",
                                    "window_start", "window_end", "is_fraud"))


def partner_billing(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Q1 result rows (``PARTNER_BILLING_COLUMNS``)."""
    c = require_keys(only_clicks(ad), ["partner_id", "ts"])
    folded = click_fold_rollup(c, BILLING_FRAUD_KEY, ["partner_id"], rules.billing_window,
                               rules.fraud_limit, rules.order)
    out = folded.select(
        "partner_id",
        F.col("normal_amount").alias("aggregated_amount"),
        F.col("fraudulent_amount"),
        F.col("normal_amount").alias("total_billing_amount"),
        "window_start", "window_end",
    )
    return output_window(out).select(*PARTNER_BILLING_COLUMNS)
