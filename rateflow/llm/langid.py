"""Language identification with one Kneser-Ney character model per language.

Learns from all labelled rows given (no sample). Every whole text is scored under each
language's model; the language of the lowest cross-entropy per character wins. Its score
is the posterior probability under equal priors, with the evidence of a text counted as
that of ``EVIDENCE`` characters at most, so that long texts don't all score 1. A
prediction is ``accepted`` when its cross-entropy does not exceed the ``ACCEPT`` quantile
that the training texts of that language reach: a text in none of the learned languages
is so told apart, though it still gets the nearest one.

Defined cases: null texts and texts without a letter are ``und`` with score 0 and not
accepted; so is everything when nothing was learned. Rows without a language teach
nothing but are predicted; a null doc_id is neither held out nor learned from; ties go to the
language first in order; repeated rows each get their own row. Extra columns are ignored.
A very long text is scored whole, in one task that holds about 80 times its bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm import charlm
from rateflow.llm.common import written

EVIDENCE = 40
ACCEPT = 0.999
UNKNOWN = "und"


def learn(labelled: DataFrame) -> charlm.Model:
    """Models from rows (lang, text); rows with null lang are left out."""
    return charlm.train(charlm.count_grams(labelled.select(F.col("lang").alias("grp"), "text"), letters_only=True),
                        modified=False)


def predict(docs: DataFrame, model: charlm.Model, keep: list[str], evidence: int = EVIDENCE) -> DataFrame:
    """The columns ``keep`` of docs with lang_pred, score and cross_entropy (in nats)."""
    groups = sorted(r["grp"] for r in model.groups().collect())
    none = (F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("cross_entropy"))
    if not groups:
        return docs.select(*keep, *none)
    texts = docs.select(F.lit("").alias("grp"), F.struct(*keep).alias("row"), F.col("text").cast("string").alias("text"))
    scored = charlm.score(texts, charlm.EachGroup(model, groups), letters_only=True)
    n = F.greatest("n", F.lit(1)).cast("double")
    scored = scored.select("row", "has_letter", n.alias("n"), F.transform("sums", lambda v: -v / n).alias("per_char"))
    scored = scored.select("*", F.array_min("per_char").alias("lowest"))
    weighed = F.transform("per_char", lambda x: F.exp((F.col("lowest") - x) * F.least("n", F.lit(float(evidence)))))
    odds = F.aggregate(weighed, F.lit(0.0), lambda a, b: a + b)
    best = F.element_at(F.array(*(F.lit(g) for g in groups)), F.array_position("per_char", F.col("lowest")).cast("int"))
    known = F.col("has_letter")
    return scored.select("row.*", F.when(known, best).otherwise(UNKNOWN).alias("lang_pred"), F.when(known, 1 / odds).otherwise(0.0).alias("score"),
                         F.when(known, F.col("lowest")).alias("cross_entropy"))


def identify(docs: DataFrame, learns: str, accept: float = ACCEPT) -> DataFrame:
    """Learn from the rows of docs that the SQL condition ``learns`` selects (of those with a
    language) and predict all: doc_id, learned, lang_pred, score, cross_entropy, accepted."""
    rows = docs.withColumn("learned", F.coalesce(F.expr(learns), F.lit(False)) & F.col("lang").isNotNull())
    model = learn(rows.where("learned").select("lang", "text"))
    # lang comes along to calibrate with the training rows after predicting.
    scored = written(predict(rows, model, ["doc_id", "learned", "lang"]), "languages")
    limits = written(scored.where("learned and cross_entropy is not null").groupBy(F.col("lang").alias("lang_pred"))
                     .agg(F.percentile_approx("cross_entropy", accept, 10_000).alias("most")), "limits")
    return (scored.drop("lang").join(limits, "lang_pred", "left")
            .select("doc_id", "learned", "lang_pred", "score", "cross_entropy",
                    F.coalesce(F.col("cross_entropy") <= F.col("most"), F.lit(False)).alias("accepted")))
