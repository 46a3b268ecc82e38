"""Classification: by label similarity, by text, by text and image features together."""

from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, RegexTokenizer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from adgleaner import constants
from adgleaner.functions import values
from adgleaner.operators.word_vectors import WordVectors
from adgleaner.session import shared_folder

# A label set larger than this is an input mistake, not something to collect.
MAX_LABELS = 1000


def with_product_text(df: DataFrame, column: str = "product", keep_empty: bool = False) -> DataFrame:
    """Add the text to classify; rows without any are dropped unless `keep_empty`."""
    text = values.product_text(F.col("title"), F.col("name"), F.col("description"))
    with_text = df.withColumn(column, text)
    return with_text if keep_empty else with_text.where(F.col(column) != "")


# --- label similarity --------------------------------------------------------


def label_matrix(labels: DataFrame, label: str, vector: str) -> tuple[list, np.ndarray]:
    """Labels and their unit vectors, read to the driver; fails beyond `MAX_LABELS`."""
    rows = labels.select(label, vector).orderBy(label).limit(MAX_LABELS + 1).collect()
    if len(rows) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} candidate labels")
    matrix = np.array([r[1] for r in rows], dtype=np.float64)
    return [r[0] for r in rows], matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def similarity(vector: Column, names: list, matrix: np.ndarray, label_type: str) -> Column:
    """Struct (label, score): softmax over the cosines to all labels, the first on a tie."""
    n_dims = matrix.shape[1]
    arrow_type = {"string": pa.string(), "int": pa.int32()}[label_type]

    @F.arrow_udf(f"struct<label:{label_type},score:double>")
    def score(vectors: pa.Array) -> pa.Array:
        valid = vectors.is_valid().to_numpy(zero_copy_only=False)
        flat = vectors.drop_null().flatten().to_numpy(zero_copy_only=False)
        rows = flat.reshape(-1, n_dims).astype(np.float64)
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        cosines = np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0) @ matrix.T
        weights = np.exp(cosines - cosines.max(axis=1, keepdims=True))
        best = cosines.argmax(axis=1)
        top = weights[np.arange(len(best)), best] / weights.sum(axis=1)
        picks = np.full(len(valid), -1)
        picks[valid] = best
        scores = np.zeros(len(valid))
        scores[valid] = top
        label = pa.array([names[i] if i >= 0 else None for i in picks], arrow_type)
        return pa.StructArray.from_arrays([label, pa.array(scores, mask=~valid)], ["label", "score"])

    return score(vector)


def zero_shot(
    df: DataFrame, vector: str, labels: DataFrame, label: str = "label", label_vector: str = "vector"
) -> DataFrame:
    """Add `label_product` and `score_product` by similarity to the label vectors. No join."""
    names, matrix = label_matrix(labels, label, label_vector)
    label_type = labels.schema[label].dataType.simpleString()
    best = similarity(F.col(vector), names, matrix, label_type)
    return (
        df.withColumn("best", best)
        .withColumns({"label_product": F.col("best.label"), "score_product": F.col("best.score")})
        .drop("best")
    )


def _word_vectors(df: DataFrame, text: str, out: str, dims: int = 256) -> DataFrame:
    """Word counts hashed into `dims` numbers."""
    tokens = RegexTokenizer(inputCol=text, outputCol="words", pattern=r"(?U)\W+", minTokenLength=1).transform(df)
    counted = HashingTF(inputCol="words", outputCol="counts", numFeatures=dims).transform(tokens)
    return counted.withColumn(out, vector_to_array("counts")).drop("words", "counts")


def zero_shot_text(
    df: DataFrame,
    text: str = "product",
    labels: Sequence[str] = constants.CANDIDATE_LABELS,
    template: str = constants.HYPOTHESIS_TEMPLATE,
    vectors: WordVectors | None = None,
) -> DataFrame:
    """Zero-shot for texts: the sentence of each label and the text meet as word vectors.

    With `vectors` learnt from a corpus (`word_vectors.learn`) they need no word in common. The
    words of the template are the same for all labels and are left out then; a text without
    a known word has no label, and a label without one is an error.
    """
    if vectors:
        known = [(name, vectors.of(name)) for name in labels]
        if unknown := [name for name, v in known if v is None]:
            raise ValueError(f"no known word in {unknown}")
        rows = [(name, [float(x) for x in v]) for name, v in known]
        of_labels = df.sparkSession.createDataFrame(rows, "label string, vector array<double>")
        embedded = df.withColumn("text_vector", vectors.embed(F.col(text)))
        return zero_shot(embedded, "text_vector", of_labels).drop("text_vector")
    sentences = df.sparkSession.createDataFrame(
        [(name, template.format(name)) for name in labels], "label string, sentence string"
    )
    hashed = _word_vectors(df, text, "text_vector")
    return zero_shot(
        hashed, "text_vector", _word_vectors(sentences, "sentence", "vector")
    ).drop("text_vector")


# --- trained classifiers -----------------------------------------------------


def _words(text: str, dims: int) -> list:
    tokens = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"(?U)\W+", minTokenLength=1)
    return [tokens, HashingTF(inputCol="_words", outputCol="_word_counts", numFeatures=dims)]


def _regression(features: str, target: str) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=target, rawPredictionCol="_raw",
        probabilityCol="_probability", predictionCol="_prediction", maxIter=20, regParam=0.01,
    )


def _fitted(stages: list, df: DataFrame) -> PipelineModel:
    """The trained model as saved and loaded: without the training summary, which
    holds on to the session and then keeps tasks from being serialised."""
    path = shared_folder(df.sparkSession, "model")
    Pipeline(stages=stages).fit(df).write().save(path)
    return PipelineModel.load(path)


def train_text_model(df: DataFrame, text: str, target: str, dims: int = 1 << 14) -> PipelineModel:
    return _fitted([*_words(text, dims), _regression("_word_counts", target)], df)


def train_text_image_model(
    df: DataFrame, text: str, image_vector: str, image_dims: int, target: str, dims: int = 1 << 14
) -> PipelineModel:
    """Text and image features side by side; `image_vector` is an ML vector of `image_dims` numbers."""
    # The stated size spares a look at the first row, which may not exist.
    sized = VectorSizeHint(inputCol=image_vector, size=image_dims)
    both = VectorAssembler(inputCols=["_word_counts", image_vector], outputCol="_features")
    return _fitted([*_words(text, dims), sized, both, _regression("_features", target)], df)


def image_vectors(df: DataFrame, array: str, out: str) -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(array)))


def _scored(df: DataFrame, model: PipelineModel, label: str, score: str | None) -> DataFrame:
    out = model.transform(df).withColumn(label, F.col("_prediction").cast("int"))
    if score:
        out = out.withColumn(score, F.array_max(vector_to_array("_probability")))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != label], label, *([score] if score else []))


def text_labels(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Add `label` (0 or 1) and its `score`."""
    return _scored(df, model, "label", "score")


def text_image_labels(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with an image path, with `predicted_label`; the column is there even for no rows."""
    return _scored(df.where(F.col("image_path").isNotNull()), model, "predicted_label", None)


@lru_cache(maxsize=8)
def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# --- custom scorers ----------------------------------------------------------


def score_with(make_scorer: Callable[[], Callable[..., pd.Series]], result: str, *columns: Column) -> Column:
    """Column from a scorer of one's own, called on batches of rows.

    `make_scorer()` loads the model; it runs once per task, not per batch. Rows
    are scored where they are, so a value that many rows share moves nothing.
    """

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in batches:
            yield scorer(*batch)

    def run_one(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for batch in batches:
            yield scorer(batch)

    if len(columns) == 1:
        run_one.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
        return F.pandas_udf(run_one, result)(*columns)
    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, result)(*columns)


# --- which classifier --------------------------------------------------------


def classify(
    df: DataFrame, task: str, column: str | None = None, model: PipelineModel | None = None, vectors: WordVectors | None = None
) -> DataFrame:
    """Run the classifiers of a task. `column` names the text column that is made."""
    text = column or "product"
    if task == "zero-shot-classification":
        return zero_shot_text(with_product_text(df, text), text, vectors=vectors)
    if task == "text-classification":
        return text_labels(with_product_text(df, text), model)
    if task == "multi-model":
        if "image_path" not in df.columns:
            raise ValueError("multi-model needs image_path: run the image step first")
        return text_image_labels(with_product_text(df, text, keep_empty=True), model)
    if task == "both":
        return text_labels(zero_shot_text(with_product_text(df, text), text, vectors=vectors), model)
    raise ValueError(f"unknown task {task!r}")


# --- sampling ----------------------------------------------------------------


def stratified_sample(df: DataFrame, target: str, id_column: str, percent: dict[int, int]) -> DataFrame:
    """Mark `percent[class]` of the rows of each class, by a hash of the id: a rerun marks the same."""
    share = F.conv(F.substring(F.md5(F.col(id_column).cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint") % 100
    wanted = F.lit(False)
    for value, limit in percent.items():
        wanted = F.when(F.col(target) == value, share < limit).otherwise(wanted)
    return df.withColumn("sample_image", wanted)
