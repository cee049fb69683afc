"""Fitted preprocessing as Spark ML stages.

Each Estimator learns a parameter table with one aggregation (modes,
vocabularies, per-category label statistics, column minima) on the training
rows only, and its Model applies it as column expressions, so a fitted
``PipelineModel`` transforms batch or streaming data without Python UDFs.
Fitted parameters are kept as JSON params, so ``DefaultParamsWritable`` saves
them with the pipeline.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import with_global_rank

from ..sources.tables import work_dir

NULL_KEY = "\u0000null"  # map key standing for a missing category
# Up to this many fitted categories are literals in the plan; a larger target
# encoder keeps its table in the shared folder and joins it.
LITERAL_CATEGORIES = 5_000
# The named one-hot encoder makes a column per category, which has to be a bounded
# number; the sparse one has no bound.
MAX_FITTED_CATEGORIES = 100_000
# A fitted table of at most this many rows for one column, as counted, is broadcast.
BROADCAST_CATEGORIES = 100_000


def _check_size(n: int, what: str) -> None:
    if n > MAX_FITTED_CATEGORIES:
        raise ValueError(f"{what}: {n} categories exceed the bound {MAX_FITTED_CATEGORIES} of columns; SparseOneHotEncoder has none")


def _key(c):
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NULL_KEY))


class _JsonParams(Params):
    fitted = Param(Params._dummy(), "fitted", "fitted parameters as JSON", typeConverter=TypeConverters.toString)

    def _get_fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))


# ------------------------------------------------------------------ fitted tables

class TableModelWriter(MLWriter):
    """Saves params as ``metadata`` and the fitted table, where there is one, as ``data`` in the model's own folder."""

    def __init__(self, model: _TableModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.active())
        if self.model.has_table():
            self.model.table().write.parquet(f"{path}/data")


class TableModelReader(MLReader):
    """Reads what ``TableModelWriter`` saved; the table is read from the model's folder."""

    def load(self, path: str):
        model = DefaultParamsReader(_TableModel).load(path)
        if model.has_table():
            model._set(tablePath=f"{path}/data")
        return model


class _TableModel(Params, MLWritable, MLReadable):
    """A model with a fitted parquet table (column, v, and one value of the schema ``VALUE``) beside its params."""

    VALUE = "e double"
    tablePath = Param(Params._dummy(), "tablePath", "folder of the fitted table, empty without one", typeConverter=TypeConverters.toString)
    tableRows = Param(Params._dummy(), "tableRows", "rows of the fitted table by column, as JSON", typeConverter=TypeConverters.toString)

    def has_table(self) -> bool:
        return self.isDefined(self.tablePath) and self.getOrDefault(self.tablePath) != ""

    def table(self) -> DataFrame:
        schema = f"column string, v string, {self.VALUE}"
        return SparkSession.active().read.schema(schema).parquet(self.getOrDefault(self.tablePath))

    def looked_up(self, df: DataFrame, cols, names) -> DataFrame:
        """``df`` plus one column of ``names`` per input column: the table's value for the row's category, null if unseen.

        One left join per column on the category. A column's part of the table is broadcast when it is counted small;
        otherwise both sides are bare shuffles, which AQE can split at a hot category.
        """
        value, rows = self.VALUE.split()[0], json.loads(self.getOrDefault(self.tableRows))
        for i, (c, name) in enumerate(zip(cols, names)):
            part = self.table().where(F.col("column") == c).select(F.col("v").alias(f"_k{i}"), F.col(value).alias(name))
            if rows.get(c, 0) <= BROADCAST_CATEGORIES:
                part = F.broadcast(part)
            df = df.join(part, _key(c) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
        return df

    def write(self) -> TableModelWriter:
        return TableModelWriter(self)

    @classmethod
    def read(cls) -> TableModelReader:
        return TableModelReader()


def _save_table(table: DataFrame, name: str) -> tuple[str, dict[str, int]]:
    """(folder, rows by column) of a fitted table written to the shared folder."""
    path = work_dir(table.sparkSession, name)
    table.write.parquet(path)
    rows = table.sparkSession.read.schema(table.schema).parquet(path).groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    return path, {r["column"]: r["n"] for r in rows.collect()}      # one row per encoded column


# ------------------------------------------------------------------ sentinel imputers

class SentinelImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Replace a sentinel category (``XNA``) by the most frequent other value
    (ties: the smallest) or by a constant."""

    sentinel = Param(Params._dummy(), "sentinel", "value treated as missing", typeConverter=TypeConverters.toString)
    strategy = Param(Params._dummy(), "strategy", "most_frequent or constant", typeConverter=TypeConverters.toString)
    fillValue = Param(Params._dummy(), "fillValue", "constant fill", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, sentinel="XNA", strategy="most_frequent", fillValue="missing_value"):
        super().__init__()
        self._setDefault(sentinel="XNA", strategy="most_frequent", fillValue="missing_value")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        fills = {}
        if self.getOrDefault(self.strategy) == "constant":
            fills = {c: self.getOrDefault(self.fillValue) for c in cols}
        else:
            s = self.getOrDefault(self.sentinel)
            long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string")
                                                          .alias("v")) for c in cols])).alias("r")).select("r.*")
            counts = (long.where(F.col("v").isNotNull() & (F.col("v") != s))
                      .groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")))
            # most frequent value per column (ties: smallest) by aggregates, not a window per column
            best = counts.groupBy("column").agg(F.max("n").alias("_m"))
            top = (counts.join(F.broadcast(best), on="column").where(F.col("n") == F.col("_m"))
                   .groupBy("column").agg(F.min("v").alias("v")).collect())  # one row per column
            fills = {r["column"]: r["v"] for r in top}
        return SentinelImputerModel(inputCols=cols, sentinel=self.getOrDefault(self.sentinel),
                                    fitted=json.dumps(fills))


class SentinelImputerModel(Model, HasInputCols, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    sentinel = Param(Params._dummy(), "sentinel", "value treated as missing", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, sentinel="XNA", fitted="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.getOrDefault(self.sentinel)
        fills = self._get_fitted()
        return df.withColumns({c: F.when(F.col(f"`{c}`") == s, F.lit(fills.get(c))).otherwise(F.col(f"`{c}`"))
                               for c in self.getInputCols()})


# ------------------------------------------------------------------ one-hot with names

class NamedOneHotEncoder(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """One 0/1 column ``<col>_<category>`` per learned category (sorted; a
    missing value is a category of its own, named ``nan``, sorted last). A
    two-category column keeps only its second category. Unknown categories
    give all zeros. Optional ``maxCategories`` keeps the most frequent ones
    plus ``<col>_infrequent_sklearn``."""

    dropBinary = Param(Params._dummy(), "dropBinary", "one column for binary", typeConverter=TypeConverters.toBoolean)
    maxCategories = Param(Params._dummy(), "maxCategories", "cap, 0 = none", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCols=None, dropBinary=True, maxCategories=0):
        super().__init__()
        self._setDefault(dropBinary=True, maxCategories=0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string")
                                                      .alias("v")) for c in cols])).alias("r")).select("r.*")
        grouped = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"))
        counts = grouped.limit(MAX_FITTED_CATEGORIES + 1).collect()  # distinct categories, bounded fetch
        _check_size(len(counts), "one-hot vocabulary")
        cap = self.getOrDefault(self.maxCategories)
        vocab = {}
        for c in cols:
            cats = [(r["v"], r["n"]) for r in counts if r["column"] == c]
            ordered = sorted(cats, key=lambda t: (t[0] is None, t[0] or ""))
            infrequent = False
            if cap and len(ordered) > cap:
                # rank by count; ties keep the later category in sort order
                ranked = sorted(range(len(ordered)), key=lambda i: (ordered[i][1], i))
                keep = set(ranked[-(cap - 1):])
                ordered = [ordered[i] for i in range(len(ordered)) if i in keep]
                infrequent = True
            names = [v for v, _ in ordered]
            if self.getOrDefault(self.dropBinary) and len(names) == 2 and not infrequent:
                names = names[1:]
            vocab[c] = {"cats": names, "infrequent": infrequent, "all": [v for v, _ in ordered]}
        return NamedOneHotModel(inputCols=cols, fitted=json.dumps(vocab))


class NamedOneHotModel(Model, HasInputCols, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, fitted="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def output_names(self) -> list[str]:
        out = []
        for c, spec in self._get_fitted().items():
            out += [f"{c}_{'nan' if v is None else v}" for v in spec["cats"]]
            if spec["infrequent"]:
                out.append(f"{c}_infrequent_sklearn")
        return out

    def _transform(self, df: DataFrame) -> DataFrame:
        new = {}
        for c, spec in self._get_fitted().items():
            x = F.col(f"`{c}`").cast("string")
            for v in spec["cats"]:
                hit = x.isNull() if v is None else F.coalesce(x == v, F.lit(False))
                new[f"{c}_{'nan' if v is None else v}"] = hit.cast("double")
            if spec["infrequent"]:
                known = [v for v in spec["all"] if v is not None]
                inside = F.coalesce(x.isin(known), F.lit(False))
                if None in spec["all"]:
                    inside = inside | x.isNull()
                new[f"{c}_infrequent_sklearn"] = (~inside).cast("double")
        return df.withColumns(new).drop(*self._get_fitted().keys())


# ------------------------------------------------------------------ sparse one-hot by an index table

def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """A sparse ML vector from arrays of ascending indices and their values, without a Python worker.

    The vector type is stored as the struct (type, size, indices, values); ``from_json`` builds it from that form.
    """
    form = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))
    return F.from_json(F.to_json(F.struct(form.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


class SparseOneHotEncoder(Estimator, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """One sparse 0/1 vector per row, whatever the number of categories.

    The fitted model is a table (column, category, index): indices run over the
    columns in order and inside a column over its sorted categories (missing is
    one, last). A two-category column keeps only its second category unless
    ``dropBinary`` is off, categories named ``<col>_<category>`` in
    ``dropNames`` get no index, and unseen categories set nothing. Categories
    are counted, sorted and written by tasks; none reaches the driver.
    """

    dropBinary = Param(Params._dummy(), "dropBinary", "one index for binary", typeConverter=TypeConverters.toBoolean)
    dropNames = Param(Params._dummy(), "dropNames", "encoded names left out", typeConverter=TypeConverters.toListString)

    @keyword_only
    def __init__(self, inputCols=None, outputCol="onehot", dropBinary=True, dropNames=()):
        super().__init__()
        self._setDefault(outputCol="onehot", dropBinary=True, dropNames=[])
        self._set(**{k: list(v) if k == "dropNames" else v for k, v in self._input_kwargs.items()})

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        place = {c: i for i, c in enumerate(cols)}
        seen = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), _key(c).alias("v"))
                                             for c, i in place.items()])).alias("r")).select("r.*").distinct()
        if self.getOrDefault(self.dropBinary):
            ends = seen.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min(_order()).alias("first"))
            first = {r["column"]: r["first"]["v"] for r in ends.where("n = 2").collect()}      # one row per encoded column
            for c, v in first.items():
                seen = seen.where(~((F.col("column") == c) & (F.col("v") == v)))
        drop = list(self.getOrDefault(self.dropNames))
        if drop:
            seen = seen.where(~_encoded_name().isin(drop))
        ranked = with_global_rank(seen, [F.col("place"), *_order_columns()], "idx")
        path, rows = _save_table(ranked.select("column", "v", F.col("idx").cast("int").alias("idx")), "onehot")
        return SparseOneHotModel(inputCols=cols, outputCol=self.getOutputCol(), tablePath=path, tableRows=json.dumps(rows))


def _order_columns() -> list[Column]:
    return [(F.col("v") == NULL_KEY).alias("missing"), F.col("v")]


def _order() -> Column:
    return F.struct(*_order_columns())


def _encoded_name() -> Column:
    return F.concat("column", F.lit("_"), F.when(F.col("v") == NULL_KEY, "nan").otherwise(F.col("v")))


class SparseOneHotModel(_TableModel, Model, HasInputCols, HasOutputCol):
    VALUE = "idx int"

    @keyword_only
    def __init__(self, inputCols=None, outputCol="onehot", tablePath="", tableRows="{}"):
        super().__init__()
        self._setDefault(outputCol="onehot")
        self._set(**self._input_kwargs)

    def size(self) -> int:
        return sum(json.loads(self.getOrDefault(self.tableRows)).values())

    def feature_table(self) -> DataFrame:
        """(idx, name): the name ``<col>_<category>`` of each position of the vector."""
        return self.table().select("idx", _encoded_name().alias("name"))

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        names = [f"_idx{i}" for i in range(len(cols))]
        found = F.filter(F.array(*[F.col(n) for n in names]), lambda i: i.isNotNull())
        vector = sparse_vector(self.size(), found, F.transform(found, lambda _: F.lit(1.0)))
        vector = vector.alias(self.getOutputCol(), metadata={"ml_attr": {"num_attrs": self.size()}})     # read by an assembler
        found = self.looked_up(df, cols, names)
        kept = [F.col(f"`{c}`") for c in df.columns if c not in (*cols, self.getOutputCol())]
        return found.select(*kept, vector)


# ------------------------------------------------------------------ smoothed target encoder

class SmoothedTargetEncoder(Estimator, HasInputCols, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Category -> blend of the category's label mean and the prior, weighted
    by ``1 / (1 + exp(-(n - minSamplesLeaf) / smoothing))``; a category seen
    once gets the prior; missing is a category; unseen categories get the prior.
    Per-category statistics come from one grouped aggregate over all encoded
    columns at once (a table of distinct categories, collected)."""

    minSamplesLeaf = Param(Params._dummy(), "minSamplesLeaf", "", typeConverter=TypeConverters.toFloat)
    smoothing = Param(Params._dummy(), "smoothing", "", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, labelCol="label", minSamplesLeaf=20.0, smoothing=10.0):
        super().__init__()
        self._setDefault(minSamplesLeaf=20.0, smoothing=10.0, labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols, y = self.getInputCols(), F.col(self.getLabelCol()).cast("double")
        long = df.select(y.alias("_y"), F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _key(c).alias("v"))
                                                             for c in cols])).alias("r")).select("r.*", "_y")
        stats = long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n"), F.count("_y").alias("k"), F.sum("_y").alias("s"))
        path, rows = _save_table(stats, "target-statistics")          # counted once; what follows reads the statistics
        stats = df.sparkSession.read.schema(stats.schema).parquet(path)
        first = stats.where(F.col("column") == cols[0]).agg(F.sum("s"), F.sum("k")).first()      # every row is in every column
        prior = first[0] / first[1] if first[1] else None
        msl, sm = self.getOrDefault(self.minSamplesLeaf), self.getOrDefault(self.smoothing)
        weight = 1 / (1 + F.exp(-(F.col("n") - F.lit(msl)) / F.lit(sm)))
        enc = F.when(F.col("n") == 1, F.lit(prior)).otherwise(
            F.lit(prior) * (1 - weight) + F.try_divide("s", "k") * weight)
        table = stats.select("column", "v", enc.cast("double").alias("e"))
        if sum(rows.values()) > LITERAL_CATEGORIES:      # too many for the plan: the table is joined
            path, rows = _save_table(table, "target-encoder")
            return SmoothedTargetModel(inputCols=cols, tablePath=path, tableRows=json.dumps(rows), fitted=json.dumps({"prior": prior}))
        mapping = {c: {} for c in cols}
        for r in table.collect():
            mapping[r["column"]][r["v"]] = r["e"]
        return SmoothedTargetModel(inputCols=cols, tablePath="", fitted=json.dumps({"prior": prior, "mapping": mapping}))


class SmoothedTargetModel(_TableModel, Model, HasInputCols, _JsonParams):
    """The encoder's table as literals in the plan, or joined by key when it is large; saved whole with the model."""

    @keyword_only
    def __init__(self, inputCols=None, tablePath="", tableRows="{}", fitted="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fit, cols = self._get_fitted(), self.getInputCols()
        prior = F.lit(fit["prior"]).cast("double")
        if self.has_table():
            names = [f"_e{i}" for i in range(len(cols))]
            out = self.looked_up(df, cols, names)
            return out.withColumns({c: F.coalesce(F.col(n), prior) for c, n in zip(cols, names)}).drop(*names)
        new = {}
        for c in cols:
            m = fit["mapping"][c]
            lookup = F.create_map(*[x for k, v in m.items() for x in (F.lit(k), F.lit(v).cast("double"))])
            new[c] = F.coalesce(lookup[_key(c)], prior)
        return df.withColumns(new)


# ------------------------------------------------------------------ missing-value fill for trees

class MissingValueFill(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Trees in Spark reject missing values; put them below each column's
    training minimum (min - 1) so a split can still isolate them."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        cols = self.getInputCols()
        row = df.agg(*[F.min(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]).first()
        fills = {c: (row[c] - 1.0 if row[c] is not None and not math.isnan(row[c]) else -1.0) for c in cols}
        return MissingValueFillModel(inputCols=cols, fitted=json.dumps(fills))


class MissingValueFillModel(Model, HasInputCols, _JsonParams, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, fitted="{}"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self._get_fitted()
        return df.withColumns({c: F.coalesce(F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")),
                                             F.lit(v)) for c, v in fills.items()})


class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Second stage dropping chosen encoded columns."""

    @keyword_only
    def __init__(self, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        present = [c for c in self.getInputCols() if c in df.columns]
        return df.drop(*present)
