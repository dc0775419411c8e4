"""Fitted transforms: parameters are small tables, learned once and applied to any data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wearline.functions.scalar import clip, cut, log1p_clipped
from wearline.operators.aggregates import stack
from wearline.operators.quality import iqr_bounds
from wearline.operators.ordering import number_rows
from wearline.operators.quantiles import quantile_row
from wearline.schema import MODEL_FEATURES, RUL, ENTITY, CYCLE, DATASET_ID
from wearline.session import stage

SCALER_SCHEMA = T.StructType(
    [T.StructField("feature", T.StringType())]
    + [T.StructField(n, T.DoubleType()) for n in ("mean", "scale", "min", "max")]
)
MANIFEST_SCHEMA = T.StructType([T.StructField("pos", T.LongType()), T.StructField("name", T.StringType())])

# Up to this many different values a column may become one-hot or dummy columns.
MAX_CATEGORIES = 1_000


# Scaling ---------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, population std (1 where it is zero), min and max of each column, in one pass."""
    fitted = df.agg(
        *[F.struct(
            F.lit(c).alias("feature"),
            F.avg(c).alias("mean"),
            F.when(F.min(c) == F.max(c), 1.0).otherwise(F.stddev_pop(c)).alias("scale"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
        ).alias(f"_{j}") for j, c in enumerate(columns)]
    )
    return stack(fitted, [], len(columns))


def apply_scaler(df: DataFrame, params: DataFrame, method: str = "standard", columns: list[str] | None = None) -> DataFrame:
    """Scale with fitted parameters; a column without parameters is an error, never a refit."""
    known = {r["feature"]: r for r in params.collect()}
    columns = list(known) if columns is None else columns
    missing = [c for c in columns if c not in known]
    if missing:
        raise ValueError(f"no fitted parameters for {missing}")
    scaled = {}
    for c in columns:
        r = known[c]
        if method == "standard":
            scaled[c] = (F.col(c) - r["mean"]) / r["scale"]
        elif method == "minmax":
            scaled[c] = (F.col(c) - r["min"]) / ((r["max"] - r["min"]) or 1.0)
        else:
            raise ValueError(f"unknown scaling method: {method}")
    return df.withColumns(scaled)


# Feature manifest --------------------------------------------------------------------------


def feature_manifest(spark: SparkSession, columns: list[str], limit: int | None = None) -> DataFrame:
    """The feature names in column order, as a small table; a model of fixed width takes the first `limit`."""
    features = [c for c in columns if c not in (*ENTITY, CYCLE, RUL)][:limit]
    return spark.createDataFrame([(i, c) for i, c in enumerate(features)], MANIFEST_SCHEMA)


def manifest_names(manifest: DataFrame) -> list[str]:
    return [r["name"] for r in manifest.orderBy("pos").collect()]


def align_features(df: DataFrame, manifest: DataFrame, keep: list[str]) -> DataFrame:
    """Bring columns to the manifest: absent ones become 0.0, others are dropped, order is kept."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(0.0).alias(c) for c in manifest_names(manifest)]
    )


# Imputation --------------------------------------------------------------------------------


def most_frequent(df: DataFrame, column: str):
    """The most frequent value, the smallest one among equals."""
    row = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.min_by(column, F.struct((-F.col("n")).alias("n"), F.col(column))).alias("value"))
        .first()
    )
    return row["value"]


def fit_imputer(df: DataFrame, columns: list[str], strategy: str, constant=None) -> dict:
    if strategy == "constant":
        return {c: constant for c in columns}
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    if strategy == "median":
        return {c: q[0] for c, q in quantile_row(df, columns, [0.5]).items()}
    if strategy == "most_frequent":
        return {c: most_frequent(df, c) for c in columns}
    raise ValueError(f"unknown strategy: {strategy}")


def apply_imputer(df: DataFrame, values: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})


# Categories ----------------------------------------------------------------------------------


def categories(df: DataFrame, column: str) -> list:
    """Sorted present values of a column that is to become columns; for more of them see `one_hot_sparse`."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column).limit(MAX_CATEGORIES + 1)
    found = [r[0] for r in values.collect()]
    if len(found) > MAX_CATEGORIES:
        raise ValueError(f"{column} has more than {MAX_CATEGORIES} values; use one_hot_sparse")
    return found


def one_hot(df: DataFrame, column: str, known: list, drop_first: bool = True, prefix: str | None = None) -> DataFrame:
    """0/1 columns for the known categories; a value outside them gets zeros everywhere."""
    prefix = prefix or column
    return df.withColumns(
        {f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in known[drop_first:]}
    )


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(column, index): sorted present values numbered from 0, of any number."""
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return number_rows(values, [], [column], "index", total="size").withColumn("index", F.col("index") - 1)


def one_hot_sparse(df: DataFrame, column: str, index: DataFrame, drop_first: bool = True, name: str | None = None) -> DataFrame:
    """The 0/1 vector of a category as a struct (size, places of ones); unknown values have no ones."""
    first = int(drop_first)
    known = index.select(column, (F.col("index") - first).alias("_at"))
    size = (index.agg(F.max("size")).first()[0] or first) - first
    ones = F.when(F.col("_at") >= 0, F.array("_at")).otherwise(F.array().cast("array<bigint>"))
    vector = F.struct(F.lit(size).cast("long").alias("size"), ones.alias("ones"))
    return df.join(known, column, "left").select(*df.columns, vector.alias(name or f"{column}_vector"))


# Binning -------------------------------------------------------------------------------------


def quantile_edges(df: DataFrame, column: str, bins: int, merge_duplicates: bool = False) -> list[float]:
    edges = quantile_row(df, [column], [i / bins for i in range(bins + 1)])[column]
    if len(set(edges)) < len(edges):
        if not merge_duplicates:
            raise ValueError(f"bin edges are not unique: {edges}")
        edges = sorted(set(edges))
    return edges


def quantile_bins(df: DataFrame, column: str, bins: int, name: str, merge_duplicates: bool = False) -> DataFrame:
    """Bin number 0..bins-1 between exact quantile edges; the lowest edge belongs to bin 0."""
    edges = quantile_edges(df, column, bins, merge_duplicates)
    return df.withColumn(name, cut(column, edges, list(range(len(edges) - 1)), include_lowest=True))


# Types ---------------------------------------------------------------------------------------

INTEGER_BITS = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}


def narrowest_integer(low: int, high: int) -> str:
    """The smallest signed type that holds both values."""
    return next(kind for kind, bits in INTEGER_BITS.items() if -(1 << bits - 1) <= low and high < 1 << bits - 1)


def downcast(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Narrow long columns by their value range and doubles to floats; one min/max pass."""
    exclude = exclude or []
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType) and f.name not in exclude]
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType) and f.name not in exclude]
    casts = {c: F.col(c).cast("float") for c in doubles}
    if longs:
        row = df.agg(*[F.struct(F.min(c), F.max(c)).alias(c) for c in longs]).first()
        casts |= {c: F.col(c).cast(narrowest_integer(*row[c])) for c in longs if row[c][0] is not None}
    return df.withColumns(casts)


# Column transform ------------------------------------------------------------------------------

TRANSFORM_VERSION = 1
# One row per fitted number, most frequent value or category; `pos` is a column's or category's place.
TRANSFORM_SCHEMA = "version int, step string, column string, pos long, value double, text string"


class ColumnTransform:
    """Fitted numeric (mean fill, cap, log1p, scale) and categorical (mode fill, one-hot) steps, held by one table.

    The table is all there is to save, load or apply; categories stay in it, of any number, and only the
    numbers of a numeric column and the short category lists come to the driver. Categories are told
    apart by their text. Unknown categories and, without a mode, missing ones have no 1.
    """

    def __init__(self, params: DataFrame):
        self.params = params
        rows = params.where("step NOT IN ('category')").collect()
        versions = {r["version"] for r in rows}
        if versions != {TRANSFORM_VERSION}:
            raise ValueError(f"the fitted transform has version {sorted(versions)}, not {TRANSFORM_VERSION}")
        self.fitted = {(r["step"], r["column"]): r["value"] if r["text"] is None else r["text"] for r in rows}
        self.numeric_columns, self.category_columns = (
            [r["column"] for r in sorted(rows, key=lambda r: r["pos"]) if r["step"] == step] for step in ("mean", "size")
        )

    def save(self, path: str) -> None:
        self.params.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ColumnTransform:
        return cls(spark.read.schema(TRANSFORM_SCHEMA).parquet(path))

    def numeric(self, df: DataFrame) -> DataFrame:
        """The numeric columns before scaling."""
        means = {c: self.fitted["mean", c] for c in self.numeric_columns}
        return _prepared(df, means, {c: (self.fitted["low", c], self.fitted["high", c]) for c in self.numeric_columns})

    def _scaled(self, df: DataFrame) -> DataFrame:
        return self.numeric(df).withColumns({c: (F.col(c) - self.fitted["centre", c]) / self.fitted["scale", c] for c in self.numeric_columns})

    def _text(self, column: str):
        return F.coalesce(F.col(column).cast("string"), F.lit(self.fitted.get(("mode", column))))

    def size(self, column: str) -> int:
        """Number of places of a category column; the first category has none."""
        return max(0, int(self.fitted["size", column]) - 1)

    def _categories(self, column: str) -> DataFrame:
        return self.params.where((F.col("step") == "category") & (F.col("column") == column)).select("pos", "text")

    def _placed(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Add the place of the row's 1, or nothing."""
        known = self._categories(column).where("pos > 0").select(F.col("text").alias("_text"), (F.col("pos") - 1).alias(name))
        return df.withColumn("_text", self._text(column)).join(known, "_text", "left").drop("_text")

    def transform(self, df: DataFrame) -> DataFrame:
        """Scaled numbers; a 0/1 column per category but the first, or above MAX_CATEGORIES a sparse `{column}_vector`."""
        out = self._scaled(df)
        for c in self.category_columns:
            if self.size(c) < MAX_CATEGORIES:
                values = [r["text"] for r in self._categories(c).where("pos > 0").orderBy("pos").collect()]
                out = out.withColumns({f"{c}_{v}": F.coalesce((self._text(c) == v).cast("int"), F.lit(0)) for v in values})
            else:
                ones = F.when(F.col("_at").isNotNull(), F.array("_at")).otherwise(F.array().cast("array<bigint>"))
                vector = F.struct(F.lit(self.size(c)).cast("long").alias("size"), ones.alias("ones"))
                out = self._placed(out, c, "_at").withColumn(f"{c}_vector", vector).drop("_at")
        return out.drop(*self.category_columns)

    def vectors(self, df: DataFrame, name: str = "features") -> DataFrame:
        """All outputs as one sparse vector (size, places, values): numbers first, then each category column's places."""
        out, at = self._scaled(df), len(self.numeric_columns)
        places, values = [F.lit(i).cast("long") for i in range(at)], [F.col(c) for c in self.numeric_columns]
        for i, c in enumerate(self.category_columns):
            out = self._placed(out, c, f"_at{i}")
            places.append(F.col(f"_at{i}") + at)
            values.append(F.when(F.col(f"_at{i}").isNotNull(), 1.0))
            at += self.size(c)
        vector = F.struct(F.lit(at).cast("long").alias("size"), F.array_compact(F.array(*places)).alias("places"), F.array_compact(F.array(*values)).alias("values"))
        return out.withColumn(name, vector).drop(*self.numeric_columns, *self.category_columns, *[f"_at{i}" for i in range(len(self.category_columns))])


def _prepared(df: DataFrame, means: dict, bounds: dict) -> DataFrame:
    filled = apply_imputer(df, means)
    return filled.withColumns({c: log1p_clipped(clip(c, lo, hi)) for c, (lo, hi) in bounds.items()})


def fit_column_transform(df: DataFrame, numeric: list[str], categorical: list[str]) -> ColumnTransform:
    """Each stage is fitted on the output of the stage before it; the categories are numbered where they are."""
    spark = df.sparkSession
    means = fit_imputer(df, numeric, "mean")
    bounds = iqr_bounds(apply_imputer(df.select(*numeric), means), numeric)
    scaler = {r["feature"]: r for r in fit_scaler(_prepared(df.select(*numeric), means, bounds), numeric).collect()}
    rows = []
    for i, c in enumerate(numeric):
        fitted = {"mean": means[c], "low": bounds[c][0], "high": bounds[c][1], "centre": scaler[c]["mean"], "scale": scaler[c]["scale"]}
        rows += [(TRANSFORM_VERSION, step, c, i, None if v is None else float(v), None) for step, v in fitted.items()]
    tables = []
    for i, c in enumerate(categorical):
        text = df.select(F.col(c).cast("string").alias("text"))
        mode = most_frequent(text, "text")
        index = stage(category_index(text, "text").select(F.col("index").alias("pos"), "text"), "categories")
        rows += [(TRANSFORM_VERSION, "size", c, i, float(index.count()), None)]
        rows += [(TRANSFORM_VERSION, "mode", c, i, None, mode)] if mode is not None else []
        tables.append(index.select(
            F.lit(TRANSFORM_VERSION).alias("version"), F.lit("category").alias("step"), F.lit(c).alias("column"), "pos", F.lit(None).cast("double").alias("value"), "text"
        ))
    return ColumnTransform(reduce(DataFrame.unionByName, tables, spark.createDataFrame(rows, TRANSFORM_SCHEMA)))


def without_dataset(df: DataFrame) -> DataFrame:
    return df.drop(DATASET_ID)
