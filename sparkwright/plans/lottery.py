"""Car-plate lottery study (Q1-Q7) as functions of (apply, lucky).

``apply``: one row per application number, columns ``batchNum`` (``yyyyMM``
string, compared as a string) and ``carNum``; one person may hold several
numbers in one batch (the multiplier). ``lucky``: one row per winning number.

Scale notes
-----------
* ``batchNum`` stays a string. Where it is a stored column, ``like``/``>=``
  on it reach the Parquet scan as pushed filters; on the driver tables it is
  derived from ``o_orderdate``, so the filter runs right after the scan, in
  the same code-generated stage.
* Joins on ``carNum`` are done between per-car aggregates, never between raw
  rows: ``apply x lucky`` on a car with k numbers and w wins yields k*w rows,
  so the plans multiply pre-aggregated counts instead. The result is the same
  and both join sides are one row per car, so a hot car cannot blow up the
  join.
* Every group-by gets a partial aggregate before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwright.operators.aggregates import count_by, frequency_histogram

BATCH = "batchNum"
CAR = "carNum"


def apply_distinct(apply: DataFrame) -> DataFrame:
    """A4: one row per person per batch."""
    return apply.select(BATCH, CAR).distinct()


def headcount(apply: DataFrame, lucky: DataFrame,
              distinct_pairs: DataFrame | None = None) -> DataFrame:
    """Q1: application rows, winner rows and distinct (batch, car) pairs
    (``distinct_pairs``, if given, is ``apply_distinct(apply)`` already built)."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")

    return (one(apply, "apply_rows")
            .unionByName(one(lucky, "lucky_rows"))
            .unionByName(one(distinct_pairs if distinct_pairs is not None
                             else apply_distinct(apply), "apply_distinct_pairs")))


def apply_histogram(apply: DataFrame) -> DataFrame:
    """Q2: how many people took part in n batches (x_axis = n, y_axis = people)."""
    return frequency_histogram(apply_distinct(apply), CAR).orderBy("x_axis")


def lucky_histogram(apply: DataFrame, lucky: DataFrame) -> DataFrame:
    """Q3: the Q2 histogram restricted to winners.

    Reference: ``apply_distinct JOIN lucky.select(carNum) USING carNum`` and a
    count per car. Winner duplicates multiply rows (no dedupe), so the count
    per car is ``batches(car) * wins(car)``; both factors are aggregated first.
    """
    batches = count_by(apply_distinct(apply), CAR, "n_batches")
    wins = count_by(lucky.select(CAR), CAR, "n_wins")
    per_car = (batches.join(wins, CAR, "inner")
               .select(CAR, (F.col("n_batches") * F.col("n_wins")).alias("x_axis")))
    return count_by(per_car, "x_axis", "y_axis").orderBy("x_axis")


def _rate(denominator: DataFrame, molecule: DataFrame) -> DataFrame:
    return (denominator.join(molecule, BATCH, "inner")
            .withColumn("ratio", F.round(F.col("molecule") / F.col("denominator"), 5))
            .orderBy(BATCH))


def win_rate(apply: DataFrame, lucky: DataFrame) -> DataFrame:
    """Q4: winners / distinct applicants per batch, rounded HALF_UP to 5 places."""
    denominator = count_by(apply_distinct(apply), BATCH, "denominator")
    molecule = count_by(lucky, BATCH, "molecule")
    return _rate(denominator, molecule)


def win_rate_for_year(apply: DataFrame, lucky: DataFrame, year: str) -> DataFrame:
    """Q5: Q4 for batches whose id starts with ``year`` (a StartsWith filter)."""
    denominator = count_by(apply_distinct(apply), BATCH, "denominator")
    molecule = count_by(lucky.filter(F.col(BATCH).like(f"{year}%")), BATCH, "molecule")
    return _rate(denominator, molecule)


def _per_car_numbers(apply: DataFrame, since: str) -> DataFrame:
    """Per car: the most numbers held in one batch, over all batches
    (``max_all``) and over batches >= ``since`` (``max_since``, null if none).

    One scan and two partial-aggregated group-bys, shared by Q6 and Q7.
    """
    numbers = count_by(apply.select(BATCH, CAR), [BATCH, CAR], "n_numbers")
    return numbers.groupBy(CAR).agg(
        F.max("n_numbers").alias("max_all"),
        F.max(F.when(F.col(BATCH) >= F.lit(since), F.col("n_numbers"))).alias("max_since"))


def _wins_since(lucky: DataFrame, since: str) -> DataFrame:
    return count_by(lucky.filter(F.col(BATCH) >= F.lit(since)).select(CAR), CAR, "n_wins")


def _winner_multipliers(per_car: DataFrame, wins: DataFrame) -> DataFrame:
    """Reference: raw applications JOIN winners' carNum, count per (batch,
    car), max per car. After the join a (batch, car) count is
    ``numbers(batch, car) * wins(car)``, and ``wins(car)`` does not depend
    on the batch, so the max per car is ``max_all * wins``: the join runs
    between one-row-per-car aggregates."""
    return per_car.join(wins, CAR, "inner").select(
        CAR, (F.col("max_all") * F.col("n_wins")).alias("multiplier"))


def multiplier_winners(apply: DataFrame, lucky: DataFrame, since: str) -> DataFrame:
    """Q6: winners (batch >= since) per maximal multiplier. Only winners'
    applications are counted: the semi-join drops the others before the
    counting shuffles."""
    wins = _wins_since(lucky, since)
    own = apply.select(BATCH, CAR).join(wins.select(CAR), CAR, "left_semi")
    per_car = _winner_multipliers(_per_car_numbers(own, since), wins)
    return count_by(per_car, "multiplier", "cnt").orderBy("multiplier")


def multiplier_applicants(apply: DataFrame, since: str) -> DataFrame:
    """Applicants (batch >= since) per maximal multiplier: (multiplier, apply_cnt)."""
    numbers = count_by(apply.filter(F.col(BATCH) >= F.lit(since)).select(BATCH, CAR),
                       [BATCH, CAR], "n_numbers")
    per_car = numbers.groupBy(CAR).agg(F.max("n_numbers").alias("multiplier"))
    return count_by(per_car, "multiplier", "apply_cnt")


def multiplier_rate(apply: DataFrame, lucky: DataFrame, since: str) -> DataFrame:
    """Q7: win rate per maximal multiplier among applicants with batch >= since.

    Applicants are counted by ``max_since``; winners by the Q6 multiplier
    (over all batches, as in the reference). Each car's two multipliers are
    emitted as tagged rows of one per-car table and counted in a single
    group-by, so the applications are scanned and shuffled once and no
    histogram-to-histogram join is needed (the reference's left join of
    applicants with winners becomes ``apply_cnt > 0``).
    """
    per_car = _per_car_numbers(apply, since).join(_wins_since(lucky, since), CAR, "left")
    tagged = per_car.select(F.inline(F.array(
        F.struct(F.lit(True).alias("is_app"), F.col("max_since").alias("multiplier")),
        F.struct(F.lit(False).alias("is_app"),
                 (F.col("max_all") * F.col("n_wins")).alias("multiplier")))))
    hist = (tagged.filter(F.col("multiplier").isNotNull())
            .groupBy("multiplier")
            .agg(F.count_if(F.col("is_app")).alias("apply_cnt"),
                 F.count_if(~F.col("is_app")).alias("lucy_cnt")))
    return (hist.filter(F.col("apply_cnt") > 0)
            .withColumn("ratio", F.round(F.col("lucy_cnt") / F.col("apply_cnt"), 5))
            .orderBy("multiplier"))


def report(apply: DataFrame, lucky: DataFrame, year: str, since: str) -> dict[str, DataFrame]:
    """All lottery results; the distinct pairs feed five of them, so they are
    persisted once (MEMORY_AND_DISK: recomputed from lineage if an executor
    is lost). The persisted frame is returned as ``distinct_pairs``; call
    ``unpersist()`` on it once the results are written."""
    distinct_pairs = apply_distinct(apply).persist()
    cached = distinct_pairs.select(BATCH, CAR)
    return {
        "distinct_pairs": distinct_pairs,
        "headcount": headcount(apply, lucky, cached),
        "apply_hist": frequency_histogram(cached, CAR).orderBy("x_axis"),
        "lucky_hist": lucky_histogram(cached, lucky),
        "rate": win_rate(cached, lucky),
        "rate_year": win_rate_for_year(cached, lucky, year),
        "multiplier": multiplier_winners(apply, lucky, since),
        "multiplier_rate": multiplier_rate(apply, lucky, since),
    }
