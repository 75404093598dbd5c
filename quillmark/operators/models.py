"""Text classification and topic models on MLlib."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LinearSVC
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import CountVectorizer, SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.functions import text

#: Terms of the vocabulary, a bound of what the driver holds; a term must be in two documents at least.
VOCABULARY = 1 << 17


def features(content: str) -> list:
    """Stages for a bag of word pairs (present or not) with the number of words."""
    return [
        SQLTransformer(statement=f"SELECT *, filter(split(lower(trim({content})), '\\\\s+'), w -> w <> '') AS words FROM __THIS__"),
        SQLTransformer(statement="SELECT *, if(size(words) > 1, zip_with(slice(words, 1, size(words) - 1), slice(words, 2, size(words) - 1), (a, b) -> concat_ws(' ', a, b)), array('')) AS pairs, CAST(size(words) AS DOUBLE) AS n_words FROM __THIS__"),
        CountVectorizer(inputCol="pairs", outputCol="bag", binary=True, minDF=2, vocabSize=VOCABULARY),
        VectorAssembler(inputCols=["bag", "n_words"], outputCol="features"),
    ]


def labelled(df: DataFrame, content: str, label: str) -> DataFrame:
    return df.filter(F.col(label).isNotNull() & (F.col(label) != "") & F.col(content).isNotNull())


def train_classifier(df: DataFrame, content: str, label: str, good: str = "good"):
    """A linear SVM on df; rows without a label are left out. Texts must not be null."""
    x = labelled(df, content, label).withColumn("label", (F.col(label) == good).cast("double"))
    return Pipeline(stages=[*features(content), LinearSVC(regParam=1e-3, maxIter=40, standardization=True)]).fit(x)


def classify(model, df: DataFrame) -> DataFrame:
    return model.transform(df).withColumn("margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "words", "pairs", "bag", "features", "n_words")


def in_training(key: str, seed: int, share: float = 0.7) -> Column:
    """By a hash of the key, the same on every run and partitioning."""
    return F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), F.lit(10_000)) < int(share * 10_000)


def split_by_key(df: DataFrame, key: str, seed: int, share: float = 0.7) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    p = in_training(key, seed, share)
    return df.filter(p), df.filter(~p)


def quality(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(tp, fp, fn, precision, recall, f1)."""
    y, z = F.col(label) == 1, F.col(prediction) == 1
    return rates(df.agg(F.count_if(y & z).alias("tp"), F.count_if(~y & z).alias("fp"), F.count_if(y & ~z).alias("fn")))


def rates(n: DataFrame) -> DataFrame:
    """n, which has tp, fp and fn, with precision, recall and f1."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return n.select("*", F.try_divide(tp, tp + fp).alias("precision"), F.try_divide(tp, tp + fn).alias("recall"), F.try_divide(2.0 * tp, 2 * tp + fp + fn).alias("f1"))


def train_topics(df: DataFrame, content: str, topics: int = 100, rounds: int = 20, seed: int = 1):
    """(vectoriser, model): latent Dirichlet allocation over words without stop words; every text counts in every round.

    Fitted by expectation-maximisation: the online optimizer draws its rows with replacement, so that even at a rate of 1 it
    leaves out a third of them a round. Its priors are one above those of a Gibbs sampler, here 0.01 a topic and 0.005 a word.
    """
    x = df.filter(F.col(content).isNotNull()).withColumn("words", text.tokens(F.col(content)))
    cv = CountVectorizer(inputCol="words", outputCol="features", minDF=2, vocabSize=VOCABULARY).fit(x)
    lda = LDA(k=topics, maxIter=rounds, seed=seed, docConcentration=[1.01], topicConcentration=1.005, optimizer="em")
    return cv, lda.fit(cv.transform(x).select("features"))


def topics_of(model, df: DataFrame, content: str) -> DataFrame:
    """df with the distribution over topics."""
    cv, lda = model
    x = lda.transform(cv.transform(df.filter(F.col(content).isNotNull()).withColumn("words", text.tokens(F.col(content)))))
    return x.withColumn("topics", vector_to_array("topicDistribution")).drop("words", "features", "topicDistribution")


def document_words(model, df: DataFrame, id_col: str, content: str, most: int = 100) -> DataFrame:
    """(id, word): the words of each text that are among the heaviest of a topic the text has a share in, each once.

    The prior gives every text with a word of the vocabulary a share above 0 in every topic, so that no share has to be worked out:
    for that MLlib holds several copies of the whole matrix of words by topics in the driver.
    """
    heavy = topic_words(model, most).select("word").distinct()
    x = df.filter(F.col(content).isNotNull()).select(F.col(id_col).alias("id"), F.explode(F.array_distinct(text.tokens(F.col(content)))).alias("word"))
    return x.join(heavy, "word").select("id", "word")


def topic_words(model, most: int = 10) -> DataFrame:
    """(topic, place, word, weight): the heaviest words of each topic; the vocabulary is bounded."""
    cv, lda = model
    d = lda.describeTopics(most).select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights")).alias("place", "t"))
    rows = d.select("topic", F.col("place") + 1, "t.termIndices", "t.termWeights").collect()  # topics times most, whatever the vocabulary
    names = cv.vocabulary
    return d.sparkSession.createDataFrame([(t, k, names[i], w) for t, k, i, w in rows], "topic int, place int, word string, weight double")
