"""Many small standardised regressions at once, from mergeable sums per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumenfold.functions.stats import correlation, two_sided_p
from lumenfold.operators.corpus import TOP, counted, counted_frequencies, top_tokens
from lumenfold.plans import stage


def word_regressions(
    reviews: DataFrame,
    text: str = "text",
    target: str = "rating",
    control: str | None = None,
    words: DataFrame | None = None,
    top: int = TOP,
    tests: int | None = None,
    clip: bool = False,
    missing: str = "zero",
    required: Sequence[str] = (),
    se: str = "simple",
    case_fold: bool = False,
) -> DataFrame:
    """Regress the target on the relative frequency of each of the ``top`` tokens.

    (word, beta, p, n): standardised slope of the word, two-sided p times the number
    of tests (not clipped unless asked for), number of documents. With ``control`` (a
    0/1 column) the slope is that of the two-variable model. Documents without text, target,
    control or a ``required`` column count as all-zero rows, or are dropped (``missing``). ``se="ols"`` takes
    the correlation of word and control into the standard error, ``"simple"`` does not.

    ``words`` (column ``word``) replaces the top tokens; the number of tests is then theirs.

    The wanted words (a short list) are counted inside each row, and only these counts are
    staged. Only non-zero frequencies become rows, and combine per word before the shuffle; the
    moments of those rows are merged with the zero rows in closed form. Rows need no id.
    """
    marked = _marked_rows(reviews, text, target, control, required, missing)
    if words is None:
        words, number = stage(top_tokens(reviews, top, text), "words"), top
    else:
        words = stage(words.select("word").distinct(), "words")
        number = words.count()
    chosen = [r["word"] for r in words.select("word").collect()]
    rows = stage(counted(marked, chosen, text, ["whole", "y", "c"]), "counted")
    kept = rows.where("whole") if missing == "drop" else rows
    found = counted_frequencies(kept.where("whole"), words, ["y", "c"], case_fold)
    everything = kept.select("y", "c", F.lit("").alias("word"), F.lit(0.0).alias("frequency"))
    sparse = found.unionByName(everything)

    x = F.col("frequency")
    moments = sparse.groupBy("word").agg(
        F.count("*").alias("k"),
        F.avg(x).alias("mean_x"),
        F.var_pop(x).alias("var_x"),
        F.covar_pop(x, "y").alias("cov_xy"),
        F.covar_pop(x, "c").alias("cov_xc"),
        F.avg("y").alias("mean_y"),
        F.avg("c").alias("mean_c"),
        F.stddev_pop("y").alias("std_y"),
        F.stddev_pop("c").alias("std_c"),
        F.covar_pop("y", "c").alias("cov_yc"),
    )
    # One row per word and one, under the empty word, for all documents.
    parts = stage(moments, "moments")
    total = parts.where("word = ''").select(F.struct("k", "mean_y", "mean_c", "std_y", "std_c", "cov_yc")).scalar()

    # Population moments over all n rows, from those of the k rows that hold the word and
    # n - k rows with x = 0. A word that counts in no document has no slope and no row.
    share = F.col("k") / F.col("all.k")
    joined = parts.where("word <> ''").withColumn("all", total)
    merged = joined.select(
        "word",
        F.col("all.k").alias("n"),
        "all.std_y",
        "all.std_c",
        "all.cov_yc",
        F.sqrt(share * (F.col("var_x") + F.col("mean_x") * F.col("mean_x") * (1.0 - share))).alias("std_x"),
        (share * (F.col("cov_xy") + F.col("mean_x") * (F.col("mean_y") - F.col("all.mean_y")))).alias("cov_xy"),
        (share * (F.col("cov_xc") + F.col("mean_x") * (F.col("mean_c") - F.col("all.mean_c")))).alias("cov_xc"),
    )
    if control is None:
        beta, t, df = slope_test(correlation(F.col("cov_xy"), F.col("std_x"), F.col("std_y")), F.col("n"))
    else:
        beta, t, df = controlled_slope_test(
            correlation(F.col("cov_xy"), F.col("std_x"), F.col("std_y")),
            correlation(F.col("cov_yc"), F.col("std_y"), F.col("std_c")),
            correlation(F.col("cov_xc"), F.col("std_x"), F.col("std_c")),
            F.col("n"),
            se,
        )
    tested = merged.select("word", beta.alias("beta"), t.alias("t"), df.alias("df"), "n")
    p = bonferroni(two_sided_p(F.col("t"), F.col("df")), number if tests is None else tests, clip)
    return tested.select("word", "beta", p.alias("p"), "n")


def _marked_rows(
    reviews: DataFrame, text: str, target: str, control: str | None, required: Sequence[str], missing: str
) -> DataFrame:
    """(text, whole, y, c): whether the row is complete; target and control are 0 where it is not."""
    if missing not in ("zero", "drop"):
        raise ValueError("missing is 'zero' or 'drop'")
    whole = F.lit(True)
    for name in [text, target, *([control] if control else []), *required]:
        whole = whole & F.col(name).isNotNull()
    c = F.col(control).cast("double") if control else F.lit(0.0)
    return reviews.select(
        text,
        whole.alias("whole"),
        F.when(whole, F.col(target).cast("double")).otherwise(0.0).alias("y"),
        F.when(whole, c).otherwise(0.0).alias("c"),
    )


def slope_test(r: Column, n: Column) -> tuple[Column, Column, Column]:
    """Slope, t and degrees of freedom of the one-variable standardised model."""
    df = n - 2
    rest = F.greatest(1.0 - r * r, F.lit(0.0))
    return r, _ratio(r * F.sqrt(F.greatest(df, F.lit(0)).cast("double")), F.sqrt(rest)), df


def controlled_slope_test(
    r_xy: Column, r_cy: Column, r_xc: Column, n: Column, se: str = "simple"
) -> tuple[Column, Column, Column]:
    """Slope of x, its t and degrees of freedom with one control variable c."""
    if se not in ("simple", "ols"):
        raise ValueError("se is 'simple' or 'ols'")
    df = n - 3
    apart = F.nullif(1.0 - r_xc * r_xc, F.lit(0.0))
    beta = (r_xy - r_cy * r_xc) / apart
    beta_c = (r_cy - r_xy * r_xc) / apart
    rest = F.greatest(1.0 - beta * r_xy - beta_c * r_cy, F.lit(0.0))
    error = rest / apart if se == "ols" else rest
    return beta, _ratio(beta * F.sqrt(F.greatest(df, F.lit(0)).cast("double")), F.sqrt(error)), df


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, with a signed infinity for a perfect fit."""
    return F.when(bottom == 0, F.signum(top) * F.lit(float("inf"))).otherwise(top / bottom)


def bonferroni(p: Column, tests: int, clip: bool = False) -> Column:
    """p times the number of tests; may exceed 1 unless clipped."""
    adjusted = p * float(tests)
    return F.least(adjusted, F.lit(1.0)) if clip else adjusted


def feature_regressions(
    panel: DataFrame, features: Sequence[str], target: str, include_target: bool = False
) -> DataFrame:
    """(feature, beta, p, n): regress the target on every feature by itself, standardised.

    Standardised data have mean 0, so no intercept is needed. ``include_target`` keeps
    the target as one of the features (slope 1, p 0). p is not adjusted.
    """
    names = [f for f in features if f != target] + ([target] if include_target else [])
    y = F.col(target).cast("double")

    def of(name: str) -> Column:
        x = F.col(name).cast("double")
        both = x.isNotNull() & y.isNotNull()
        own, other = F.when(both, x), F.when(both, y)
        return F.struct(
            F.lit(name).alias("feature"),
            F.count(own).alias("n"),
            F.stddev_pop(own).alias("std_x"),
            F.stddev_pop(other).alias("std_y"),
            F.covar_pop(own, other).alias("cov_xy"),
        )

    # One row with the moments of every feature, turned into a row per feature: no row of the panel is repeated.
    whole = panel.groupBy(F.lit("all")).agg(F.array(*[of(f) for f in names]).alias("features"))
    moments = whole.select(F.inline("features")).where("n > 0")
    r = correlation(F.col("cov_xy"), F.col("std_x"), F.col("std_y"))
    if include_target:
        r = F.when(F.col("feature") == target, F.nvl2(r, F.lit(1.0), F.lit(None).cast("double"))).otherwise(r)
    beta, t, df = slope_test(r, F.col("n"))
    tested = moments.select("feature", beta.alias("beta"), t.alias("t"), df.alias("df"), "n")
    return tested.select("feature", "beta", two_sided_p(F.col("t"), F.col("df")).alias("p"), "n")


def both_ends(scores: DataFrame, score: str, ties: Sequence[str], k: int = 20, digits: int = 9) -> DataFrame:
    """The ``k`` highest and ``k`` lowest rows, marked in ``side``.

    Scores equal to ``digits`` places are ordered by the tie columns, so the choice
    does not depend on the order of a floating sum. Null and NaN scores take no part.
    The scores (one row per key) are staged, so that they are computed once for both ends.
    """
    usable = stage(scores.where(F.col(score).isNotNull() & ~F.isnan(score)), "scores")
    near = F.round(score, digits)
    high = usable.orderBy(near.desc(), *ties).limit(k).withColumn("side", F.lit("top"))
    low = usable.orderBy(near.asc(), *ties).limit(k).withColumn("side", F.lit("bottom"))
    return high.unionAll(low)
