"""Feature pipelines as MLlib stages, label maps, the stable split.

The feature stages are part of the fitted ``PipelineModel`` together with the
classifier, so batch scoring, stream scoring and what-if scoring all take
the T2 session columns and run the very same transformation (no second,
hand-written assembly at serving time).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.functions.columns import in_train_split
from basketlens.schemas import CATEGORY_FEATURES, INTENT_NUMERIC_FEATURES, UNKNOWN_CATEGORY


def _filled(cols: list[str]) -> SQLTransformer:
    """Numeric inputs as double, NULL -> 0 (the assembler rejects NULLs)."""
    sel = ", ".join(f"CAST(coalesce(CAST({c} AS DOUBLE), 0.0D) AS DOUBLE) AS f_{c}" for c in cols)
    return SQLTransformer(statement=f"SELECT *, {sel} FROM __THIS__")


def intent_feature_stages() -> list:
    """Model 1: numeric features + one-hot main category.

    The indexer keeps unseen categories as one extra index; the encoder drops
    the last slot, which is then that unseen slot: every known category has
    its own slot and an unseen one is all zeros.
    """
    cat = SQLTransformer(statement=(
        "SELECT *, coalesce(nullif(trim(main_category), ''), "
        f"'{UNKNOWN_CATEGORY}') AS main_category_in FROM __THIS__"))
    return [
        cat,
        StringIndexer(inputCol="main_category_in", outputCol="main_category_index",
                      handleInvalid="keep", stringOrderType="frequencyDesc"),
        OneHotEncoder(inputCols=["main_category_index"], outputCols=["main_category_ohe"],
                      dropLast=True),
        _filled(INTENT_NUMERIC_FEATURES),
        VectorAssembler(inputCols=[f"f_{c}" for c in INTENT_NUMERIC_FEATURES],
                        outputCol="numeric_features"),
        VectorAssembler(inputCols=["numeric_features", "main_category_ohe"], outputCol="features"),
    ]


def category_feature_stages() -> list:
    """Model 2: the six numeric features (NULL -> 0) as one vector."""
    return [
        _filled(CATEGORY_FEATURES),
        VectorAssembler(inputCols=[f"f_{c}" for c in CATEGORY_FEATURES], outputCol="features"),
    ]


def category_label_indexer() -> StringIndexer:
    """Class index of label_category: frequency order, ties alphabetical; rows
    with an unseen label are skipped.  Fitted on the whole category frame
    before the split (as the original) and kept out of the serving pipeline
    (serving frames have no label); the class names travel with the pipeline
    in its final IndexToString stage."""
    return StringIndexer(inputCol="label_category", outputCol="label", handleInvalid="skip",
                         stringOrderType="frequencyDesc")


def fit_category_labels(df: DataFrame):
    return category_label_indexer().fit(df)


def feature_names(task: str, labels: list[str]) -> list[str]:
    """Names of the vector slots, in order (for importances)."""
    if task == "intent":
        return INTENT_NUMERIC_FEATURES + [f"main_category={c}" for c in labels]
    return list(CATEGORY_FEATURES)


def fit_intent_features(df: DataFrame) -> PipelineModel:
    return Pipeline(stages=intent_feature_stages()).fit(df)


def indexer_labels(model) -> list[str]:
    """Class order of a fitted indexer, or of a pipeline's first StringIndexer
    / IndexToString stage."""
    from pyspark.ml.feature import IndexToString, StringIndexerModel
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    for st in stages:
        if isinstance(st, StringIndexerModel):
            return list(st.labels)
        if isinstance(st, IndexToString):
            return list(st.getLabels())
    raise ValueError("no fitted StringIndexer / IndexToString")


def label_map(spark: SparkSession, model) -> DataFrame:
    """(index, category) of a fitted indexer, ordered by index.

    The label array is model state of bounded size (the category vocabulary);
    it is the one thing MLlib keeps on the driver anyway.
    """
    labels = indexer_labels(model)
    return (spark.createDataFrame(list(enumerate(labels)), "index int, category string")
                 .orderBy("index"))


def split_train_test(df: DataFrame, key: str = "user_session") -> tuple[DataFrame, DataFrame]:
    """80/20 split by key hash; disjoint, total, stable under repartition."""
    flag = in_train_split(key)
    return df.filter(flag), df.filter(~flag)


def onehot_slots(df: DataFrame) -> DataFrame:
    """I3 in relational form: width of the one-hot vector and the hot slot (-1: none)."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array("main_category_ohe")
    return df.select("user_session", F.size(arr).cast("int").alias("onehot_size"),
                     (F.array_position(arr, 1.0) - 1).cast("int").alias("hot_slot"))
