"""Text classification: TF-IDF over words and word pairs, balanced logistic regression."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    IndexToString,
    Normalizer,
    StopWordsRemover,
    StringIndexer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripfunnel.session import scratch_path

# Everything between words; a word has letters, digits and underscores of any script.
BETWEEN_WORDS = r"[^\p{L}\p{N}_]+"


def with_terms(df: DataFrame, text: str = "text", stop_words: Sequence[str] = ()) -> DataFrame:
    """Adds ``terms``: the lower-case words of two or more characters that are no stop
    words, followed by the pairs of neighbours.

    The words are a column of their own first: used several times in one expression, they
    would be split out of the text again each time.
    """
    words = F.filter(F.split(F.lower(text), BETWEEN_WORDS), lambda w: F.length(w) >= 2)
    if stop_words:
        words = F.filter(words, lambda w: ~w.isin(*stop_words))
    inner = F.greatest(F.size("_words") - 1, F.lit(0))
    pairs = F.zip_with(
        F.slice("_words", 1, inner),
        F.slice("_words", 2, inner),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return df.withColumn("_words", words).withColumn(
        "terms", F.concat("_words", pairs)
    ).drop("_words")


def _occurrences(documents: DataFrame) -> DataFrame:
    """A row for each term of each document; ``first`` is 1 for the first of equal ones in a document.

    ``explode_outer`` spares the filter that Spark would derive from ``explode``, which would compute
    the terms a second time; a document without terms is one row with a null term.
    """
    ordered = documents.select(F.sort_array("terms").alias("_terms"))
    first = F.transform("_terms", lambda t, i: F.struct(
        t.alias("term"), ((i == 0) | (t != F.get("_terms", i - 1))).cast("long").alias("first")
    ))
    return ordered.select(F.explode_outer(first).alias("_t")).select("_t.term", "_t.first")


def _counted(occurrences: DataFrame) -> DataFrame:
    counted = occurrences.groupBy("term").agg(F.count(F.lit(1)).alias("tf"), F.sum("first").alias("df"))
    return counted.filter(F.col("term").isNotNull())


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def vocabulary(documents: DataFrame, size: int | None = None) -> DataFrame:
    """All terms of a ``terms`` column with their count and the number of documents
    holding them; with ``size`` the most frequent, equal counts in alphabetical order.

    One pass: terms are sorted inside their document, where the first of equal ones counts
    for the document too, and are added up in every task before the shuffle.
    """
    return _counted(_occurrences(documents)) if size is None else frequent_terms(documents, size)


def frequent_terms(
    documents: DataFrame, size: int, buckets: int = 2**20, guess_rows: int = 2000
) -> DataFrame:
    """The ``size`` most frequent terms of ``vocabulary``, without a shuffle of all terms.

    Four times as many frequent terms of about ``guess_rows`` sampled documents are a guess. A pass over all documents
    counts the guessed terms, and all others by hash bucket, so that its shuffle has numbers only. The
    least count of the ``size`` best of them is a floor: the term of that rank has no lower one. What lies in
    a bucket below the floor is below it too, and only the rest, if any, is counted by term. The result is exact
    whatever was guessed; a bad guess only makes the floor lower. The documents that hold a term are counted
    for the chosen terms alone.
    """
    share = guess_rows / max(documents.count(), 1)
    sampled = documents if share >= 1 else documents.sample(share, seed=42)
    guess = _stored(
        _counted(_occurrences(sampled)).orderBy(F.col("tf").desc(), F.col("term")).limit(4 * size).select("term"),
        "guessed-terms",
    )
    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets))
    # The guess has ``4 * size`` rows at most, and there are ``buckets`` buckets at most.
    guessed = F.broadcast(guess.select("term", F.col("term").alias("_guessed")))
    met = _stored(
        documents.select(F.explode("terms").alias("term"))
        .join(guessed, "term", "left")
        .groupBy("_guessed", F.when(F.col("_guessed").isNull(), bucket).alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("tf")),
        "term-buckets",
    )
    known = met.filter(F.col("_guessed").isNotNull())
    found = known.orderBy(F.col("tf").desc()).limit(size).agg(F.count(F.lit(1)), F.min("tf")).first()
    floor = found[1] if found[0] == size else 1
    heavy = met.filter(F.col("_guessed").isNull() & (F.col("tf") >= floor)).select("_bucket")
    counted = known.select(F.col("_guessed").alias("term"), "tf")
    rest = (
        documents.select(F.explode("terms").alias("term"))
        .join(F.broadcast(heavy), bucket == F.col("_bucket"), "left_semi")
        .join(F.broadcast(guess), "term", "left_anti")
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    if not heavy.isEmpty():
        counted = counted.unionByName(rest)
    chosen = _stored(
        counted.filter(F.col("tf") >= floor).orderBy(F.col("tf").desc(), F.col("term")).limit(size), "chosen-terms"
    )
    return (
        documents.select(F.explode(F.array_distinct("terms")).alias("term"))
        .join(F.broadcast(chosen), "term")
        .groupBy("term", "tf")
        .agg(F.count(F.lit(1)).alias("df"))
        .orderBy(F.col("tf").desc(), F.col("term"))
    )


class SentimentModel:
    """``fit`` on ``(text, sentiment)``; ``transform`` adds label, confidence and the
    probability of every label.
    """

    def __init__(
        self, max_terms: int = 5000, max_iter: int = 1000, stop_words: Sequence[str] | None = None,
        text: str = "text", label: str = "sentiment",
    ):
        self.max_terms = max_terms
        self.max_iter = max_iter
        self.stop_words = stop_words
        self.text = text
        self.label = label
        self.labels: list[str] = []
        self.pipeline: PipelineModel | None = None

    def _with_terms(self, df: DataFrame) -> DataFrame:
        return with_terms(df, self.text, self.stop_words or ())

    def fit(self, reviews: DataFrame) -> SentimentModel:
        if self.stop_words is None:
            self.stop_words = StopWordsRemover.loadDefaultStopWords("english")
        labelled = _stored(
            self._with_terms(
                reviews.filter(F.col(self.label).isNotNull()).withColumn(
                    self.label, F.col(self.label).cast("string")
                )
            ).select(self.label, "terms"),
            "labelled-terms",
        )
        classes = {
            row[0]: row[1]
            for row in labelled.groupBy(self.label).agg(F.count(F.lit(1))).collect()
        }
        n = sum(classes.values())
        chosen = sorted(
            vocabulary(labelled, self.max_terms).collect(), key=lambda r: (-r["tf"], r["term"])
        )
        words = [row["term"] for row in chosen]
        idf = [self._idf(n, row["df"]) for row in chosen]

        counts = CountVectorizerModel.from_vocabulary(words, inputCol="terms", outputCol="_counts")
        scale = ElementwiseProduct(
            scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_tfidf"
        )
        unit = Normalizer(p=2.0, inputCol="_tfidf", outputCol="_features")
        # Rows without a label are gone. Keeping unknown ones would add a class that takes probability.
        index = StringIndexer(
            inputCol=self.label, outputCol="_label", stringOrderType="alphabetAsc",
        ).fit(labelled)
        self.labels = list(index.labels)
        weight = F.create_map(
            *[
                F.lit(x)
                for name, size in classes.items()
                for x in (name, n / (len(classes) * size))
            ]
        )
        prepared = labelled.withColumn("_weight", weight[F.col(self.label)])
        for step in (counts, scale, unit, index):
            prepared = step.transform(prepared)
        # An L2 penalty of one half summed over the data, as a mean over n rows.
        classifier = LogisticRegression(
            featuresCol="_features", labelCol="_label", weightCol="_weight",
            maxIter=self.max_iter, regParam=1.0 / n, elasticNetParam=0.0,
            standardization=False, family="multinomial",
        )
        fitted = classifier.fit(prepared.select("_features", "_label", "_weight"))
        back = IndexToString(inputCol="prediction", outputCol="predicted", labels=self.labels)
        self.pipeline = PipelineModel([counts, scale, unit, fitted, back])
        return self

    @staticmethod
    def _idf(documents: int, holding: int) -> float:
        from math import log

        return log((1 + documents) / (1 + holding)) + 1

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.pipeline.transform(self._with_terms(df))
        chances = F.slice(vector_to_array("probability"), 1, len(self.labels))
        names = F.array(*[F.lit(name) for name in self.labels])
        return scored.select(
            *df.columns,
            F.col("predicted").alias("predicted_sentiment"),
            F.array_max(chances).alias("confidence"),
            F.map_from_arrays(names, chances).alias("probabilities"),
            F.col("prediction"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        meta = json.dumps(
            {
                "max_terms": self.max_terms, "max_iter": self.max_iter, "text": self.text,
                "label": self.label, "labels": self.labels, "stop_words": list(self.stop_words),
            }
        )
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(f"{path}/meta")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SentimentModel:
        meta = json.loads(spark.read.schema("meta string").json(f"{path}/meta").first()[0])
        labels = meta.pop("labels")
        model = cls(**meta)
        model.labels = labels
        model.pipeline = PipelineModel.load(f"{path}/pipeline")
        return model
