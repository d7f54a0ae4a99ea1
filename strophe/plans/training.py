"""From merged stanzas to features, models, evaluations and labels for new data."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import Model, PipelineModel
from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.arrays import join_tokens, one_hot_vector
from ..functions.text import analyze, parse_pylist
from ..operators.features import BOOLEANS, FeatureSpec, TextColumn
from ..operators.metrics import (
    accuracy, auc_ovr, class_accuracy, classification_report, confusion_matrix, one_vs_rest,
)
from ..operators.models import (
    fit_classifier, load_model, perceptron, predict, random_forest, save_model, self_train,
    svm_one_vs_rest,
)
from ..operators.rows import bools_to_int, encode_label
from ..operators.search import WEIGHT, search
from ..operators.sampling import Key, downsample, key_columns, random_split, sample_n, train_val_test, with_class_weight
from ..operators.terms import (
    Scaling, chi2_select, fit_scaling, fit_terms, fit_vocab, postings, tfidf_transform, to_sequences,
)
from ..operators.topics import TopicModel, nmf_fit
from ..sources.runs import log_run
from ..sources.staging import stage
from ..wordlists import EMOTIONS

VOCAB_SIZE, SEQUENCE_LENGTH, TOPICS, TITLE_TERMS = 20000, 150, 8, 1000

# The grids that are searched.  There is no minimum of rows for a split in the library's trees, so that is left out.
FOREST_GRID = {
    "max_features": [500, 1000, 5000, None],
    "ngram": [(1, 1), (1, 2)],
    "trees": [50, 100, 200, 300],
    "depth": [None, 10, 20, 30],
    "min_leaf": [1, 2, 4],
    "bootstrap": [True, False],
}
SVM_GRID = {"max_features": [500, 1000, 2500], "ngram": [(1, 1), (1, 2)], "c": [0.1, 1.0, 10.0], "class_weight": [None, "balanced"]}
TREE_TERMS = 5000  # stands for no limit in a search of forests, whose learner holds a bin per row and term


def with_text(df: DataFrame, tokens: str = "lemmatized_stanzas", out: str = "text_str") -> DataFrame:
    return df.withColumn(out, join_tokens(F.col(tokens)))


def mixed_spec(max_features: int | None = None, ngram: tuple[int, int] = (1, 1), **more) -> FeatureSpec:
    """TF-IDF of text and title, the scaled stanza number, six flags."""
    return FeatureSpec(texts=[TextColumn("text_str", max_features, ngram), TextColumn("title")], **more)


def text_spec(**limits) -> FeatureSpec:
    return FeatureSpec(texts=[TextColumn("text_str", **limits)], scaled=(), booleans=())


def fit_forest(train: DataFrame, params: dict | None = None, classes: Sequence[str] = EMOTIONS,
               spec: FeatureSpec | None = None) -> PipelineModel:
    """A forest with ``params`` as a search returns them, ``class_weight`` included."""
    train, params = _class_weighted(train, params or {})
    shape = {k: params.pop(k) for k in ("max_features", "ngram") if k in params}
    return fit_classifier(train, lambda ready: random_forest(**params), spec or mixed_spec(**shape), classes=classes)


def fit_svm(train: DataFrame, params: dict | None = None, classes: Sequence[str] = EMOTIONS,
            spec: FeatureSpec | None = None) -> PipelineModel:
    """Linear SVMs, one against the rest, with ``params`` as a search returns them, ``class_weight`` included."""
    train, params = _class_weighted(train, {"c": 0.9, **(params or {})})
    shape = {k: params.pop(k) for k in ("max_features", "ngram") if k in params}
    return fit_classifier(train, lambda ready: svm_one_vs_rest(n=ready.count(), **params),
                          spec or mixed_spec(**shape), classes=classes)


@dataclass(frozen=True)
class Evaluation:
    model: Model
    predictions: DataFrame  # label, predicted, probabilities where the model has them
    classes: Sequence[str]

    def report(self) -> DataFrame:
        return classification_report(self.predictions, "label", "predicted")

    def confusion(self) -> DataFrame:
        return confusion_matrix(self.predictions, self.classes, "label", "predicted")

    def class_accuracy(self) -> DataFrame:
        return class_accuracy(self.predictions, self.classes, "label", "predicted")

    def auc(self) -> DataFrame:
        return auc_ovr(one_vs_rest(self.predictions, "label", F.col("probabilities"), self.classes))


def evaluate(model: Model, test: DataFrame, classes: Sequence[str] = EMOTIONS,
             keep: Sequence[str] = ("label",)) -> Evaluation:
    return Evaluation(model, stage(predict(model, test, keep)), classes)


def train_and_evaluate(df: DataFrame, fit: Callable[[DataFrame], Model], test: float = 0.3, id_col: Key = ("id", "stanza_number"),
                       classes: Sequence[str] = EMOTIONS, save_to: str | None = None) -> Evaluation:
    """Hold out ``test``, fit on the rest, predict the held-out rows."""
    parts = stage(random_split(df, test, id_col))
    model = fit(parts.where("split = 'train'"))
    if save_to:
        save_model(model, save_to)
    return evaluate(model, parts.where("split = 'test'"), classes)


def _weighted(params: dict) -> dict:
    """``class_weight``, "balanced" or None, as the weight column of the fold store."""
    kind, rest = params.get("class_weight"), _without(params, "class_weight")
    if kind not in (None, "balanced"):
        raise ValueError(f"class_weight is \"balanced\" or None, not {kind}")
    return rest | {"weight": WEIGHT} if kind else rest


def _class_weighted(train: DataFrame, params: dict) -> tuple[DataFrame, dict]:
    """The rows with balanced weights if ``params`` ask for them, and the other parameters."""
    weighted = _weighted(params)
    return (with_class_weight(train.drop(WEIGHT), "label", WEIGHT) if params.get("class_weight") else train), weighted


def search_forest(train: DataFrame, n_iter: int = 20, k: int = 5, grid: dict | None = None,
                  classes: Sequence[str] = EMOTIONS, **options) -> tuple[dict, DataFrame]:
    """Random search of forests; ``class_weight`` may be part of the grid."""
    spec = lambda shape: mixed_spec(**({"max_features": TREE_TERMS} | {n: v for n, v in shape.items() if v is not None}))
    return search(train, spec, lambda p, n: random_forest(**_weighted(p)), grid or FOREST_GRID,
                  n_iter=n_iter, k=k, classes=classes, **options)


def search_svm(train: DataFrame, n_iter: int = 2, k: int = 3, grid: dict | None = None,
               classes: Sequence[str] = EMOTIONS, **options) -> tuple[dict, DataFrame]:
    """Random search of linear SVMs, one against the rest."""
    return search(train, lambda shape: mixed_spec(**shape), lambda p, n: svm_one_vs_rest(n=n, **_weighted(p)),
                  grid or SVM_GRID, n_iter=n_iter, k=k, classes=classes, **options)


def _without(params: dict, name: str) -> dict:
    return {k: v for k, v in params.items() if k != name}


def fit_chi2_forest(train: DataFrame, k: int = 5000, doc: str = "id", text: str = "text_str",
                    classes: Sequence[str] = EMOTIONS, depth: int = 10, trees: int = 100) -> PipelineModel:
    """Counts, the ``k`` best terms by chi-squared, TF-IDF on these, a forest."""
    posted = stage(postings(train, doc, analyze(F.col(text)), ["label"]))
    spec = FeatureSpec(texts=[TextColumn(text, terms=chi2_select(posted, train, "label", k))], scaled=(), booleans=())
    return fit_forest(train, {"depth": depth, "trees": trees}, classes, spec)


# Sequences, topics and scaled numbers -------------------------------------------------------------------------

@dataclass(frozen=True)
class Preparation:
    """What is fitted on training rows and applied to any rows."""

    title_terms: DataFrame
    topics: TopicModel
    vocab: DataFrame
    scaling: Scaling
    tokens: str
    id_col: str
    stop: Sequence[str]

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with ``padded_sequence``, ``topics``, scaled ``stanza_number`` and 0/1 flags."""
        key = self.id_col
        titles = postings(df, key, analyze(F.col("title"), stop=self.stop))
        topics = self.topics.transform(tfidf_transform(titles, self.title_terms, key), df, key)
        sequences = to_sequences(df, key, self.tokens, self.vocab, SEQUENCE_LENGTH, "padded_sequence")
        scaled = df.withColumn("stanza_number", self.scaling.apply(F.col("stanza_number")))
        return bools_to_int(scaled, BOOLEANS).join(sequences, key).join(topics, key)


    def save(self, path: str) -> None:
        """Write all that was fitted below ``path``: tables, topics and one row of numbers."""
        spark = self.vocab.sparkSession
        self.title_terms.write.mode("overwrite").parquet(f"{path}/title_terms")
        self.vocab.write.mode("overwrite").parquet(f"{path}/vocab")
        self.topics.save(spark, f"{path}/topics")
        row = [(self.scaling.mean, self.scaling.std, self.tokens, self.id_col, list(self.stop))]
        spark.createDataFrame(row, "mean double, std double, tokens string, id_col string, stop array<string>").write.mode(
            "overwrite").parquet(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Preparation:
        row = spark.read.parquet(f"{path}/settings").first()
        return Preparation(spark.read.parquet(f"{path}/title_terms"), TopicModel.load(spark, f"{path}/topics"),
                           spark.read.parquet(f"{path}/vocab"), Scaling(row.mean, row.std), row.tokens, row.id_col, list(row.stop))


def title_stopwords() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def fit_preparation(train: DataFrame, tokens: str = "lemmatized_stanzas", id_col: str = "row_id",
                    stop: Sequence[str] | None = None, iterations: int = 200) -> Preparation:
    stop = title_stopwords() if stop is None else stop
    titles = stage(postings(train, id_col, analyze(F.col("title"), stop=stop)))
    terms = fit_terms(titles, train, max_features=TITLE_TERMS)
    topics = nmf_fit(tfidf_transform(titles, terms, id_col), id_col, TOPICS, iterations)
    return Preparation(terms, topics, fit_vocab(train, id_col, tokens, VOCAB_SIZE),
                       fit_scaling(train, "stanza_number"), tokens, id_col, stop)


def with_target(df: DataFrame, label: str = "label", classes: Sequence[str] = EMOTIONS) -> DataFrame:
    """``y``: the label as a 0/1 vector."""
    return df.withColumn("y", one_hot_vector(encode_label(F.col(label), classes), len(classes)))


def prepare(df: DataFrame, label: str = "label", tokens: str = "lemmatized_stanzas", id_col: str = "row_id",
            balance: bool = False, iterations: int = 200, classes: Sequence[str] = EMOTIONS) -> tuple[Preparation, DataFrame]:
    """Split 49/21/30 per class, fit on the training rows, transform all rows."""
    even = downsample(df, label, id_col) if balance else df
    parts = stage(train_val_test(even, label, id_col))
    fitted = fit_preparation(parts.where("split = 'train'"), tokens, id_col, iterations=iterations)
    return fitted, with_target(fitted.apply(parts), label, classes)


def dense_spec(max_features: int = 1000) -> FeatureSpec:
    """Input of the dense network: text TF-IDF, topics, stanza number, flags."""
    return FeatureSpec(texts=[TextColumn("text_str", max_features)], vectors=["topic_vector"])


def topic_vector(topics: Column) -> Column:
    return array_to_vector(topics)


def fit_perceptron(train: DataFrame, spec: FeatureSpec, classes: Sequence[str] = EMOTIONS,
                   max_iter: int = 100, hidden: Sequence[int] = (32, 32)) -> PipelineModel:
    def make(ready: DataFrame):
        width = len(ready.select(spec.out).first()[0])
        return perceptron(width, len(classes), hidden, max_iter)

    return fit_classifier(train, make, spec, classes=classes)


def training_run(df: DataFrame, fit: Callable[[DataFrame], Model], unlabelled: DataFrame | None = None,
                 balance: bool = False, pseudo_share: float | None = None, id_col: Key = ("id", "stanza_number"),
                 classes: Sequence[str] = EMOTIONS, save_to: str | None = None, runs: str | None = None,
                 name: str = "run") -> Evaluation:
    """Balance if asked, split, fit, self-train on unlabelled rows if given, evaluate on the test part.

    ``pseudo_share`` limits the unlabelled rows to that share of the training rows.
    The model goes to ``save_to`` and a line about the run to the table ``runs``.
    """
    even = downsample(df, "label", id_col) if balance else df
    parts = stage(train_val_test(even, "label", id_col))
    train = parts.where("split = 'train'").drop("split")
    if unlabelled is None:
        model = fit(train)
    else:
        fresh = unlabelled.select(*[c for c in train.columns if c != "label"]).dropna("any")
        if pseudo_share is not None:
            fresh = sample_n(fresh, int(train.count() * pseudo_share), id_col)
        model = self_train(train, fresh, fit)
    out = evaluate(model, parts.where("split = 'test'"), classes)
    if save_to:
        save_model(model, save_to)
    if runs:
        score = accuracy(out.predictions, "label", "predicted").first()[0]
        log_run(df.sparkSession, runs, name, {
            "balance": balance, "self_training": unlabelled is not None, "pseudo_share": pseudo_share,
        }, {"accuracy": score or 0.0})
    return out


def classify(rows: DataFrame, path: str, id_col: Key = ("id", "stanza_number"), tokens: str = "lemmatized_stanzas") -> DataFrame:
    """The key and ``label`` of new rows by a saved model; tokens may be an array, a list literal or ready text."""
    if "text_str" not in rows.columns:
        if rows.schema[tokens].dataType.simpleString() == "string":
            rows = rows.withColumn(tokens, parse_pylist(F.col(tokens)))
        rows = with_text(rows, tokens)
    keys = key_columns(id_col)
    return predict(load_model(path), rows, keys).select(*keys, F.col("predicted").alias("label"))
