"""Quality classifier: perplexity under a model of trusted text, judged by language.

An interpolated modified Kneser-Ney model of characters (as written: case, digits and
symbols count) is trained for each language on all trusted texts, those labelled with
quality 1, and one on all of them together (ALL). Documents are dealt to two folds by a hash
of doc_id, and each is scored under the models of the other fold: no document is scored under a
model that has seen it, and the models hold each text once. A document's probability mixes the
model of its language with ALL by the characters that the language's model has counted
(``MIXING`` characters weigh as much as ALL), so a language gains weight bit by bit.

Bits per character are compared with those of the trusted documents of the same language: their
mean and variance, drawn towards those of all trusted documents under ALL as if ``PRIOR`` of these
were among them. Two quantiles of the standardised bits of all trusted documents then set each
language's limits: above are symbols, shouting and word lists; below is text of few repeated
parts. Documents without a language, or in one without trusted text, are scored under ALL and
held against the mean and variance under ALL. The parameters are the same at every size.

The n-gram counts are sharded by gram, and joins of the shards give the probabilities
(see charlm). Labels join the texts on doc_id; an id filter keeps unlabelled texts out of
that shuffle.

Defined cases: null and empty texts have no perplexity and are not accepted; without any
trusted text in the other fold, or any scored trusted document, a text that has characters is
accepted; conflicting labels of one document count as not trusted; rows with null doc_id are
judged but never trusted; repeated rows are each judged alike. Extra columns are ignored. A very
long text is scored whole, in one task that holds about 80 times its bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.llm import charlm
from rateflow.llm.common import id_filter, row_key, written

LOWEST = 0.0005
HIGHEST = 0.9985
# The group of all languages together.
ALL = ""
# Characters of a language's model that weigh as much as ALL in the mixture.
MIXING = 50_000
# Trusted documents that the mean and variance under ALL count for.
PRIOR = 20
# The least standard deviation in bits.
LEAST_SPREAD = 1e-6


def trusted_ids(labels: DataFrame) -> DataFrame:
    return (labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
            .where("low = 1 and high = 1").select("doc_id"))


def _fold() -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(2))


def _trusted_rows(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    may_hold = id_filter(trusted, "doc_id")
    return docs.where(F.col("doc_id").isNotNull() & may_hold(F.col("doc_id"))).join(trusted, "doc_id", "left_semi")


def _group(fold: Column, lang: Column | str) -> Column:
    return F.concat(fold.cast("string"), F.lit(":"), lang)


def train(docs: DataFrame, trusted: DataFrame) -> charlm.Mixed:
    """Models of the texts of docs whose doc_id is in trusted, by lang and for ALL. That of the
    texts of one fold is named after the other, whose documents it scores (fold:lang)."""
    texts = _trusted_rows(docs.select("doc_id", F.coalesce("lang", F.lit(ALL)).alias("lang"), "text"), trusted)
    counts = written(charlm.count_grams(texts.select(_group(1 - _fold(), "lang").alias("grp"), "text"), letters_only=False), "grams")
    base = F.concat(F.substring_index("grp", ":", 1), F.lit(":" + ALL))
    together = counts.groupBy(base.alias("grp"), "gram").agg(F.sum("n").alias("n"))
    every = written(counts.where(F.col("grp") != base).unionByName(together), "counts")
    model = charlm.train(every, modified=True)
    size = F.sum("n")
    shares = every.groupBy("grp").agg((size / (size + MIXING)).alias("share")).select("grp", base.alias("base"), "share")
    return charlm.Mixed(model, written(shares, "shares"))


def score(docs: DataFrame, models: charlm.Mixed) -> DataFrame:
    """doc_id, row_key, lang, n_scored (characters), bits (per character, under the mixture of
    the document's language) and bits_all (under ALL), null without characters or a model."""
    there = models.shares.select(F.col("grp").alias("there"))
    texts = docs.select("doc_id", row_key().alias("row_key"), "lang", F.col("text").cast("string").alias("text"))
    texts = (texts.withColumn("grp", _group(_fold(), "lang")).join(there, F.col("grp") == F.col("there"), "left")
             .select(F.coalesce("there", _group(_fold(), F.lit(ALL))).alias("grp"), F.struct("doc_id", "row_key", "lang").alias("row"), "text"))
    scored = charlm.score(texts, models, letters_only=False)

    def bits(k: int) -> Column:
        return F.when(F.col("n") > 0, -F.col("sums")[k] / F.col("n") / F.log(F.lit(2.0)))

    return scored.select("row.*", F.col("n").alias("n_scored"), bits(0).alias("bits"), bits(1).alias("bits_all"))


def limits(scored: DataFrame, trusted: DataFrame, lowest: float, highest: float) -> DataFrame:
    """(grp, mean, spread, q): for each language of the trusted documents and ALL, what its bits
    are standardised by, and the two quantiles of all standardised bits."""
    held = written(scored.where("bits is not null").join(trusted, "doc_id", "left_semi").select("lang", "bits", "bits_all"), "held-out")
    under_all = written(held.agg(F.avg("bits_all").alias("mean_all"), F.var_pop("bits_all").alias("var_all")), "under-all")
    mean_all, var_all = under_all.select("mean_all").scalar(), under_all.select("var_all").scalar()
    own = held.where(F.col("lang").isNotNull() & (F.col("lang") != ALL)).groupBy(F.col("lang").alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("bits").alias("m"), F.var_pop("bits").alias("v"))
    nothing = under_all.select(F.lit(ALL).alias("grp"), F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("m"), F.lit(0.0).alias("v"))
    both = own.unionByName(nothing).select("*", mean_all.alias("mean_all"), var_all.alias("var_all")).where("mean_all is not null")
    weight = F.col("n") / (F.col("n") + PRIOR)
    mean = weight * F.col("m") + (1 - weight) * F.col("mean_all")
    # The variance of the two parts together, with that between their means.
    var = weight * F.col("v") + (1 - weight) * F.col("var_all") + weight * (1 - weight) * F.pow(F.col("m") - F.col("mean_all"), F.lit(2.0))
    standards = written(both.select("grp", mean.alias("mean"), F.greatest(F.sqrt(var), F.lit(LEAST_SPREAD)).alias("spread")), "standards")
    z = written(held.withColumn("grp", F.coalesce("lang", F.lit(ALL))).join(standards, "grp")
                .agg(F.percentile_approx(_z(), [lowest, highest], 10_000).alias("q")), "quantiles")
    return written(standards.select("*", z.scalar().alias("q")), "limits")


def _z() -> Column:
    return (F.col("bits") - F.col("mean")) / F.col("spread")


def classify(docs: DataFrame, labels: DataFrame, lowest: float = LOWEST, highest: float = HIGHEST) -> DataFrame:
    """One row per document row: doc_id, row_key, grp (the language that it is held against, or
    ALL), n_scored, bits, perplexity (per character), least and most (the limits in bits), accepted."""
    trusted = written(trusted_ids(labels.select("doc_id", "quality")), "trusted")
    scored = written(score(docs, train(docs, trusted)), "perplexities")
    by_group = limits(scored, trusted, lowest, highest)
    known = by_group.select(F.col("grp").alias("lang"), F.col("grp").alias("known"))
    judged = (scored.join(known, "lang", "left").withColumn("grp", F.coalesce("known", F.lit(ALL)))
              .join(by_group, "grp", "left"))
    return judged.select("doc_id", "row_key", "grp", "n_scored", "bits", F.pow(F.lit(2.0), "bits").alias("perplexity"),
                         (F.col("mean") + F.col("spread") * F.col("q")[0]).alias("least"), (F.col("mean") + F.col("spread") * F.col("q")[1]).alias("most"),
                         ((F.col("n_scored") > 0) & F.coalesce(_z().between(F.col("q")[0], F.col("q")[1]), F.lit(True))).alias("accepted"))
