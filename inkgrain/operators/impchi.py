"""Chi-square scores of weighted terms, one class against the rest, and the top terms per class."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkgrain.operators.lookup import LookupLimits, lookup_join

#: Groups per label in which terms are ranked first.
RANK_SALTS = 64


def chi2_scores(weights: DataFrame, label_counts: dict, label_col: str) -> DataFrame:
    """``(term, label, chi2)`` for every term with every label, found together or not.

    Weights are summed by term and class (partial sums on the map side, so a frequent term is never
    gathered), then by term, and the classes are spread out from one constant array: the plan does not grow with their number.
    """
    sums = weights.where(F.col("weight").isNotNull()).groupBy("term", F.col(label_col).alias("label")).agg(F.sum("weight").alias("o"))
    return chi2_of_sums(sums, label_counts)


def chi2_of_sums(sums: DataFrame, label_counts: dict) -> DataFrame:
    """:func:`chi2_scores` of weights that are added up already: ``(term, label, o)``, with a row for each class that a term was seen in."""
    n = sum(label_counts.values())
    kind = sums.schema["label"].dataType
    classes = F.array(*[F.struct(F.lit(x).cast(kind).alias("label"), F.lit(label_counts[x] / n).alias("prior")) for x in sorted(label_counts)])
    # one entry per class that the term was seen in; classes, not rows, bound it
    terms = sums.groupBy("term").agg(F.sum("o").alias("total"), F.map_from_entries(F.collect_list(F.struct("label", "o"))).alias("seen"))

    def score(c):
        total = F.col("total")
        inside, outside = total * c["prior"], total * (1 - c["prior"])
        observed = F.coalesce(F.element_at("seen", c["label"]), F.lit(0.0))
        rest = total - observed - outside
        chi2 = F.try_divide((observed - inside) * (observed - inside), inside) + F.try_divide(rest * rest, outside)
        return F.struct(c["label"].alias("label"), F.coalesce(F.nanvl(chi2, F.lit(0.0)), F.lit(0.0)).alias("chi2"))

    return terms.select("term", F.inline(F.transform(classes, score)))


def top_terms(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best ``(label, term, chi2, rank)`` per label; equal scores go by term.

    Terms are ranked in salted groups first, which pass on ``k`` per label each.
    """
    order = (F.round("chi2", 9).desc(), F.col("term"))
    salted = Window.partitionBy("label", F.pmod(F.hash("term"), F.lit(RANK_SALTS))).orderBy(*order)
    scores = scores.withColumn("__r", F.row_number().over(salted)).where(F.col("__r") <= k).drop("__r")
    ranked = scores.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def selected_vocabulary(top: DataFrame) -> DataFrame:
    """Union of the per-label selections: ``(term, labels, idx)``.

    At most labels times k rows get here, so one window without partitions numbers them.
    """
    union = top.groupBy("term").agg(F.array_sort(F.collect_set("label")).alias("labels"))
    return union.withColumn("idx", (F.row_number().over(Window.orderBy("term")) - 1).cast("int"))


def label_suffix(labels):
    return F.concat_ws("_", F.array_sort(F.transform(labels, lambda x: x.cast("string"))))


def word_feature_name(term="term", labels="labels"):
    return F.concat(F.col(term), F.lit("_labels_"), label_suffix(labels))


def char_feature_name(term="term", labels="labels"):
    return F.concat(F.lit("char_"), F.trim(F.col(term)), F.lit("_lbl_"), label_suffix(labels))


def feature_arrays(
    counts: DataFrame,
    vocabulary: DataFrame,
    selected: DataFrame,
    id_col: str,
    width: int,
    limits: LookupLimits = LookupLimits(),
    size: int | None = None,
) -> DataFrame:
    """``(id, features)``: the weights of the selected terms of each text, zeros elsewhere.

    Each text is scaled by the norm over its whole vocabulary, so the terms that are not
    selected are summed up, not dropped. Counts that are partitioned by id stay in place.
    """
    index = F.broadcast(selected.select("term", "idx"))
    known = vocabulary.join(index, "term", "left")
    weight = (1 + F.log("tf")) * F.col("idf")
    rows = lookup_join(counts, known, "term", limits, size, "df" if "df" in known.columns else None).select(id_col, "idx", weight.alias("__w"))
    slots = rows.groupBy(id_col, "idx").agg(F.sum("__w").alias("__w"), F.sum(F.col("__w") * F.col("__w")).alias("__sq"))
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "__w"))
    found = slots.groupBy(id_col).agg(F.sort_array(F.collect_list(entry)).alias("__found"), F.sqrt(F.sum("__sq")).alias("__norm"))
    return found.select(id_col, dense(F.col("__found"), F.col("__norm"), width).alias("features"))


def dense(entries, norm, width: int):
    """Array of ``width`` values from entries ``(idx, __w)`` in the order of ``idx``: each comes after as many zeros as its gap is wide."""
    zero = F.lit(0.0)

    def filled(entry, i):
        gap = entry["idx"] - F.coalesce(F.get(entries, i - 1)["idx"], F.lit(-1)) - 1
        return F.concat(F.array_repeat(zero, gap), F.array(F.coalesce(entry["__w"] / norm, zero)))

    last = F.coalesce(F.get(entries, F.size(entries) - 1)["idx"], F.lit(-1))
    return F.concat(F.flatten(F.transform(entries, filled)), F.array_repeat(zero, F.lit(width - 1) - last))
