"""Business rules as column expressions, weighted into one score per transaction."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..config import DEFAULTS, ScaleLimits
from ..functions.numbers import clip01, flag, ratio
from .basic import amount_statistics, statistics_column

NAMED_QUANTILES = [0.8, 0.95]


@dataclass(frozen=True)
class Rule:
    """``score(params)`` gives a column in [0, 1] over the feature table.

    The rule needs at least one of the ``needs`` alternatives (sets of columns) to be
    present; otherwise it scores 0 and keeps its weight in the total.
    """

    name: str
    description: str
    weight: float
    score: Callable[[dict, set], Column]
    params: dict = field(default_factory=dict)
    needs: tuple[frozenset, ...] = ()

    def column(self, columns: set) -> Column:
        if self.needs and not any(n <= columns for n in self.needs):
            return F.lit(0.0)
        return F.coalesce(self.score(self.params, columns).cast("double"), F.lit(0.0))


def _needs(*alternatives: str) -> tuple[frozenset, ...]:
    return tuple(frozenset(a.split()) for a in alternatives)


_STATS = "_amount_stats"


def _quantile(p: float) -> Column:
    """A quantile of the amounts, from the statistics row every rule shares."""
    return F.element_at(F.col(f"{_STATS}.quantiles"), F.lit(float(p)))


def _large_amount(p, _):
    amount = F.col("amount")
    z = ratio(amount - F.col(f"{_STATS}.mean"), F.col(f"{_STATS}.std"))
    return flag(amount > _quantile(p["amount_threshold_percentile"])) + flag(F.abs(z) > p["zscore_threshold"])


def _high_velocity(p, columns):
    source = "tx_velocity_24h" if "tx_velocity_24h" in columns else "user_tx_count"
    return flag(F.col(source) > p["velocity_threshold"])


def _device_change(p, columns):
    score = F.when(F.col("device_changed") == 1, 0.5).otherwise(0.0)
    if "user_device_diversity" in columns:
        score = score + F.when(F.col("user_device_diversity") > 0.5, 0.3).otherwise(0.0)
    return clip01(score)


def _weekend(p, _):
    return flag(F.col("is_weekend") & (F.col("amount") > _quantile(p["amount_threshold_percentile"])))


def _round_amount(p, _):
    amount, step = F.col("amount"), p["round_threshold"]
    return flag((amount % step == 0) & (amount >= step))


# Names, texts, weights and thresholds of the rules.
DEFAULT_RULES = (
    Rule("large_amount", "Transaction amount is unusually large", 0.3,
         lambda p, c: F.least(_large_amount(p, c), F.lit(1.0)),
         {"amount_threshold_percentile": 0.95, "zscore_threshold": 3.0}, _needs("amount")),
    Rule("unusual_hours", "Transaction at unusual hours (night/early morning)", 0.15,
         lambda p, c: flag(F.col("hour").between(p["start_hour"], p["end_hour"])),
         {"start_hour": 0, "end_hour": 6}, _needs("hour")),
    Rule("high_velocity", "High number of transactions in short time window", 0.25, _high_velocity,
         {"velocity_threshold": 5, "time_window_hours": 1}, _needs("tx_velocity_24h", "user_tx_count")),
    Rule("unusual_location", "Transaction from unusual or rare location", 0.2,
         lambda p, c: flag(F.col("location_rarity") > p["rarity_threshold"]),
         {"rarity_threshold": 0.05}, _needs("location_rarity")),
    Rule("device_change", "Transaction from different device than usual", 0.1, _device_change,
         {"consecutive_changes_threshold": 2}, _needs("device_changed")),
    Rule("amount_deviation", "Amount significantly deviates from user pattern", 0.25,
         lambda p, c: flag(F.abs("amount_zscore_user") > p["zscore_threshold"]),
         {"zscore_threshold": 2.5}, _needs("amount_zscore_user")),
    Rule("weekend_activity", "High-value transactions during weekends", 0.1, _weekend,
         {"amount_threshold_percentile": 0.8}, _needs("is_weekend amount")),
    Rule("rare_transaction_type", "Using rare transaction type for user", 0.15,
         lambda p, c: flag(F.col("type_rarity") > p["rarity_threshold"]),
         {"rarity_threshold": 0.1}, _needs("type_rarity")),
    Rule("multiple_locations", "Transactions from multiple locations same day", 0.2,
         lambda p, c: flag(F.col("user_unique_locations") >= p["location_threshold"]),
         {"location_threshold": 3, "time_window_hours": 24}, _needs("user_unique_locations")),
    Rule("round_amounts", "Suspicious round amount patterns", 0.05, _round_amount,
         {"round_threshold": 100}, _needs("amount")),
)


@dataclass(frozen=True)
class RuleSet:
    """An ordered set of rules. Changing one gives a new set."""

    rules: tuple[Rule, ...] = DEFAULT_RULES
    threshold: float = 0.5

    def _get(self, name: str) -> Rule:
        for rule in self.rules:
            if rule.name == name:
                return rule
        raise ValueError(f"no rule named {name!r}")

    @property
    def total_weight(self) -> float:
        return sum(r.weight for r in self.rules)

    def with_weight(self, name: str, weight: float) -> "RuleSet":
        self._get(name)
        if not 0 <= weight <= 1:
            raise ValueError("a weight lies between 0 and 1")
        return replace(self, rules=tuple(
            replace(r, weight=weight) if r.name == name else r for r in self.rules))

    def disabled(self, name: str) -> "RuleSet":
        """The rule still scores, but no longer counts, in the sum or in the total weight."""
        return self.with_weight(name, 0.0)

    def with_params(self, name: str, **params) -> "RuleSet":
        rule = self._get(name)
        changed = replace(rule, params={**rule.params, **params})
        return replace(self, rules=tuple(changed if r.name == name else r for r in self.rules))

    def with_rule(
        self, name: str, rule: Callable[[dict], Column] | str, weight: float, description: str,
        params: dict | None = None,
    ) -> "RuleSet":
        """Add (or replace) a rule given as a function of its parameters or as a SQL expression.

        Anything that makes a column works, so a pandas UDF applied to columns does too.
        """
        score = (lambda p, c: F.expr(rule)) if isinstance(rule, str) else (lambda p, c: rule(p))
        made = Rule(name, description, weight, score, params or {})
        kept = tuple(r for r in self.rules if r.name != name)
        return replace(self, rules=(*kept, made))

    # -- scoring ------------------------------------------------------------

    def thresholds(self, df: DataFrame, limits: ScaleLimits = DEFAULTS.limits) -> DataFrame:
        """One row with every global amount statistic the rules compare with."""
        probs = sorted({float(r.params["amount_threshold_percentile"])
                        for r in self.rules if "amount_threshold_percentile" in r.params} or {0.5})
        stats = amount_statistics(df, limits, probs)
        keys = F.array(*map(F.lit, probs))
        return stats.select(F.map_from_arrays(keys, "q").alias("quantiles"), "mean", "std")

    def score(
        self, df: DataFrame, thresholds: DataFrame | None = None,
        source: DataFrame | None = None, limits: ScaleLimits = DEFAULTS.limits,
    ) -> DataFrame:
        """Add ``rule_<name>`` and the weighted, normalised ``rule_score``.

        Thresholds are those of ``thresholds`` (a saved row), else of ``source``
        (a cheaper plan with the same rows), else of ``df``.
        """
        columns = set(df.columns)
        if "amount" in columns:
            if thresholds is None:
                thresholds = self.thresholds(df if source is None else source, limits)
            df = df.withColumn(_STATS, statistics_column(thresholds))
        scored = df.withColumns({f"rule_{r.name}": r.column(columns) for r in self.rules})
        weighted = sum((F.col(f"rule_{r.name}") * F.lit(r.weight) for r in self.rules), F.lit(0.0))
        return scored.withColumn("rule_score", ratio(weighted, F.lit(self.total_weight))).drop(_STATS)

    # -- explanations -------------------------------------------------------

    def contributions(self) -> Column:
        """Array of structs, one per rule: name, description, score, weight, contribution."""
        return F.array(*[
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.description).alias("description"),
                F.col(f"rule_{r.name}").alias("score"),
                F.lit(float(r.weight)).alias("weight"),
                (F.col(f"rule_{r.name}") * F.lit(r.weight)).alias("contribution"),
                F.lit(i).alias("position"),
            ) for i, r in enumerate(self.rules)])

    def triggered(self) -> Column:
        """The rules that fired, largest contribution first (ties in rule order)."""
        def order(a, b):
            return (
                F.when(a["contribution"] > b["contribution"], -1).when(a["contribution"] < b["contribution"], 1)
                .when(a["position"] < b["position"], -1).otherwise(1))

        fired = F.filter(self.contributions(), lambda x: x["score"] > 0)
        return F.array_sort(fired, order)

    def explain(self, scored: DataFrame) -> DataFrame:
        return scored.withColumns({
            "triggered_rules": self.triggered(),
            "rule_contributions": self.contributions(),
            "total_score": F.col("rule_score"),
        })

    def statistics(self, scored: DataFrame) -> DataFrame:
        """One row per rule: how often it fires and how much it adds. One pass over the scores."""
        rows = F.count(F.lit(1))
        stats = scored.agg(rows.alias("rows"), *[
            F.struct(
                F.count_if(F.col(f"rule_{r.name}") > 0).alias("triggered_count"),
                F.avg(f"rule_{r.name}").alias("mean_score"),
                F.max(f"rule_{r.name}").alias("max_score"),
                F.sum(F.col(f"rule_{r.name}") * F.lit(r.weight)).alias("contribution_to_total"),
            ).alias(r.name) for r in self.rules])
        return stats.select(F.inline(F.array(*[
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.description).alias("description"),
                F.lit(float(r.weight)).alias("weight"),
                F.col(f"{r.name}.triggered_count").alias("triggered_count"),
                ratio(F.col(f"{r.name}.triggered_count"), F.col("rows")).alias("trigger_rate"),
                F.col(f"{r.name}.mean_score").alias("mean_score"),
                F.col(f"{r.name}.max_score").alias("max_score"),
                F.col(f"{r.name}.contribution_to_total").alias("contribution_to_total"),
            ) for r in self.rules])))

    def top_anomalies(self, scored: DataFrame, n: int = 10) -> DataFrame:
        """The ``n`` highest rule scores with up to three rules that caused them."""
        names = F.transform(F.slice(self.triggered(), 1, 3), lambda x: x["rule_name"])
        top = scored.orderBy(F.col("rule_score").desc(), "tx_id").limit(n)
        return top.withColumn("anomaly_score", F.col("rule_score")).withColumn(
            "top_triggered_rules", F.array_join(names, "; "))

    def flagged(self, scored: DataFrame, threshold: float | None = None) -> DataFrame:
        t = self.threshold if threshold is None else threshold
        return scored.withColumn("is_anomaly", F.col("rule_score") > t)
