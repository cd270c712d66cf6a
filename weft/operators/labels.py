"""Ground truth: pairs, owners, labels, folds and fitting samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.functions import text as T
from weft.functions.hashing import validation_fold


def truth_rows(truth: DataFrame) -> DataFrame:
    """s1, ids (array) per distinct row of the truth table."""
    return truth.where(F.col("source1_entity_id").isNotNull()).select(T.entity_number(F.col("source1_entity_id")).alias("s1"), F.array_sort(F.array_distinct(T.id_list(F.col("matched_entity_ids")))).alias("ids")).distinct()


def truth_pairs(truth: DataFrame) -> DataFrame:
    """s1, source, num of every listed match."""
    return truth_rows(truth).select("s1", F.explode("ids").alias("id")).select("s1", T.entity_source(F.col("id")).alias("source"), T.entity_number(F.col("id")).alias("num"))


#: column with a row's place in the truth file, where it is known (``sources.files.in_file_order``)
ORDER = "_weft_at"


def owners(truth: DataFrame) -> DataFrame:
    """source, num, owner: a target listed under several master records belongs to the last listed; to the largest number where the rows have no order."""
    s1 = T.entity_number(F.col("source1_entity_id"))
    at = F.col(ORDER) if ORDER in truth.columns else s1
    listed = truth.where(F.col("source1_entity_id").isNotNull()).select(s1.alias("s1"), at.alias("at"), F.explode(T.id_list(F.col("matched_entity_ids"))).alias("id"))
    return listed.groupBy(T.entity_source(F.col("id")).alias("source"), T.entity_number(F.col("id")).alias("num")).agg(F.max_by("s1", F.struct("at", "s1")).alias("owner"))


def true_counts(truth: DataFrame) -> DataFrame:
    """s1, n_true over all listed matches, 0 for an empty list."""
    return truth_rows(truth).select("s1", F.size("ids").alias("n")).groupBy("s1").agg(F.sum("n").alias("n_true"))


def held_out(counts: DataFrame, master: DataFrame) -> DataFrame:
    """The counts of the validation fold: labelled records that exist (master: num) and whose number draws fold 1."""
    return counts.where(validation_fold(F.col("s1")) == 1).join(master.select(F.col("num").alias("s1")), "s1", "left_semi")


def labelled(pairs: DataFrame, owner: DataFrame) -> DataFrame:
    """Pairs with label 1 where the target's owner is the pair's master record."""
    return pairs.join(owner, ["source", "num"], "left").withColumn("label", F.coalesce((F.col("owner") == F.col("s1")).cast("int"), F.lit(0))).drop("owner")


def positive_pairs(truth: DataFrame, rec: DataFrame) -> DataFrame:
    """s1, source, num, hits=5 of every owned target of which both records exist."""
    own = owners(truth).select(F.col("owner").alias("s1"), "source", "num")
    master = rec.where(F.col("source") == 1).select(F.col("num").alias("s1"))
    targets = rec.where(F.col("source") > 1).select("source", "num")
    return own.join(master, "s1", "left_semi").join(targets, ["source", "num"], "left_semi").withColumn("hits", F.lit(5))


def fitting_sample(features: DataFrame, modulus: int = 4) -> DataFrame:
    """Training rows: fold 0, all positives and the negatives whose target number is divisible by ``modulus``."""
    number = T.entity_number(F.col("target_id"))
    return features.where((F.col("fold") == 0) & ((F.col("label") == 1) | (F.pmod(number, F.lit(modulus)) == 0)))


def class_weights(rows: DataFrame, positive_mass: float | None = None, negative_mass: float | None = None) -> DataFrame:
    """Rows with ``weight``, so that each class has the given mass (default: its own size in the fitting sample)."""
    n = rows.agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")).first()
    pos = (positive_mass if positive_mass is not None else n.pos) / max(n.pos, 1)
    neg = (negative_mass if negative_mass is not None else n.neg) / max(n.neg, 1)
    return rows.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(pos))).otherwise(F.lit(float(neg))))
