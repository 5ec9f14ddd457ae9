"""Feature pipeline: fit on train, transform anywhere.

Steps per column group (names as in the reference's output):
  offres_recues_pipeline__offresRecues : median impute → log1p → standard scale
  other_num_pipeline__<col>            : fill 0.0 → log1p → standard scale
  binary_pipeline__<col>               : fill 0 (idAccordCadre → not-null flag)
  cat_pipeline__<col>_<level>          : fill 'missing' → one-hot over train levels
                                          (unknown level → all zeros)

Standard scaling uses the *population* std (zero std → 1).  Fitting is two
aggregation passes over the train rows (exact distributed median, then
mean/std of the transformed values) plus the distinct levels of each
categorical column, one distinct over all of them.

The levels stay a written table (column, level, position), partitioned by
column; the driver has their number per column only.  A transform looks a
row's levels up by one join per categorical column: Spark broadcasts a table
of levels that is small by its measured size and shuffles a larger one, whose
hot levels its skew join splits.  ``encode`` makes sparse vectors of the
positions; only the wide form, one column per level, needs the levels' names.

No train rows: every mean is 0, every scale 1, and no column has levels.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.feature import OneHotEncoder, VectorAssembler

from bidscope.functions.columns import bin_fixed, cpv_level, cpv_2_3, dbl, notnull_flag, year_of
from bidscope.operators.quantiles import exact_quantile_row
from bidscope.operators.stats import dense_ids
from bidscope.session import scratch_path

LEVELS_SCHEMA = "level string, position bigint, column string"
OWN = "_features_"            # prefix of the columns a transform adds for itself


@dataclass(frozen=True)
class FeatureSpec:
    numerical: tuple[str, ...]
    binary: tuple[str, ...]
    categorical: tuple[str, ...]


# The three presets of the reference.
PRESETS = {
    "pred_montant": FeatureSpec(
        ("dureeMois", "offresRecues", "annee"),
        ("sousTraitanceDeclaree", "origineFrance", "marcheInnovant", "idAccordCadre"),
        ("procedure", "nature", "formePrix", "ccag", "typeGroupementOperateurs", "tauxAvance_cat", "codeCPV_2_3")),
    "marche_sim": FeatureSpec(
        ("montant", "dureeMois", "offresRecues"),
        ("sousTraitanceDeclaree", "origineFrance", "marcheInnovant", "idAccordCadre"),
        ("procedure", "nature", "formePrix", "ccag", "typeGroupementOperateurs", "tauxAvance_cat", "codeCPV_2")),
    "anomalie": FeatureSpec(
        ("montant", "dureeMois", "offresRecues"),
        ("sousTraitanceDeclaree", "origineFrance", "marcheInnovant", "idAccordCadre"),
        ("procedure", "nature", "formePrix", "ccag", "typeGroupementOperateurs", "tauxAvance_cat", "codeCPV_3")),
}


def preset(name: str) -> FeatureSpec:
    if name not in PRESETS:
        raise ValueError(f"unknown preset {name!r}; there are {', '.join(PRESETS)}")
    return PRESETS[name]


def prepare(df: DataFrame) -> DataFrame:
    """Initial step: derived columns the presets read (CPV levels, year,
    advance-rate category), added only when absent."""
    add = {}
    if "codeCPV" in df.columns:
        for lv in (2, 3, 4):
            if f"codeCPV_{lv}" not in df.columns:
                add[f"codeCPV_{lv}"] = cpv_level("codeCPV", lv)
        if "codeCPV_2_3" not in df.columns:
            add["codeCPV_2_3"] = cpv_2_3("codeCPV")
    if "annee" not in df.columns and "dateNotification" in df.columns:
        add["annee"] = year_of("dateNotification").cast("double")
    if "tauxAvance_cat" not in df.columns and "tauxAvance" in df.columns:
        add["tauxAvance_cat"] = bin_fixed("tauxAvance")
    return df.withColumns(add) if add else df


def _num_input(c: str, median: float | None) -> Column:
    x = F.col(c).cast("double")
    return F.log1p(F.coalesce(x, dbl(median if median is not None else 0.0)))


def _bin_input(c: str) -> Column:
    if c == "idAccordCadre":
        return notnull_flag(c).cast("double")
    return F.coalesce(F.col(c).cast("double"), dbl(0))


def _cat_input(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("missing"))


@dataclass
class FeatureModel:
    spec: FeatureSpec
    median_offres: float | None
    levels: DataFrame                 # written: level, position from 0 in its column, column
    mean: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)       # levels per column

    # ---- names
    @staticmethod
    def num_name(c: str) -> str:
        return "offres_recues_pipeline__offresRecues" if c == "offresRecues" else f"other_num_pipeline__{c}"

    @property
    def size(self) -> int:
        """Entries of a vector."""
        return len(self.spec.numerical) + len(self.spec.binary) + sum(self.sizes.values())

    def feature_table(self) -> DataFrame:
        """(position, feature): the name of every entry of a vector."""
        spark, names = self.levels.sparkSession, self._fixed_names()
        fixed = spark.createDataFrame(list(enumerate(names)), "position bigint, feature string")
        starts, at = [], len(names)
        for c in self.spec.categorical:
            starts.append((c, at))
            at += self.sizes[c]
        first = spark.createDataFrame(starts, "column string, _at bigint")     # a row per column of the spec
        named = F.concat(F.lit("cat_pipeline__"), "column", F.lit("_"), "level")
        return fixed.unionByName(self.levels.join(F.broadcast(first), "column").select(
            (F.col("position") + F.col("_at")).alias("position"), named.alias("feature")))

    def feature_names(self) -> list[str]:
        """All names in order, for reports on a model that has a number for
        each of them in the driver anyway."""
        return [r["feature"] for r in self.feature_table().orderBy("position").collect()]

    def _fixed_names(self) -> list[str]:
        return [self.num_name(c) for c in self.spec.numerical] + [f"binary_pipeline__{c}" for c in self.spec.binary]

    # ---- expressions
    def _num_expr(self, c: str) -> Column:
        med = self.median_offres if c == "offresRecues" else None
        return (_num_input(c, med) - dbl(self.mean[c])) / dbl(self.scale[c])

    def _fixed(self) -> list[Column]:
        return [self._num_expr(c) for c in self.spec.numerical] + [_bin_input(c) for c in self.spec.binary]

    def _place(self, d: DataFrame) -> DataFrame:
        """``d`` with the position of each categorical column's level, null
        for a level that train has not."""
        for i, c in enumerate(self.spec.categorical):
            own = self.levels.where(F.col("column") == c).select(F.col("level").alias(f"{OWN}level"),
                                                                 F.col("position").alias(f"{OWN}at_{i}"))
            d = d.join(own, _cat_input(c) == F.col(f"{OWN}level"), "left").drop(f"{OWN}level")
        return d

    def transform(self, df: DataFrame, key: str = "uid", keep: tuple[str, ...] = ()) -> DataFrame:
        """Wide form: one double column per feature name (plus ``keep``).  Its
        schema has every level, so more levels than Spark lets a pivot have
        (``spark.sql.pivotMaxValues``) are an error; ``encode`` and
        ``transform_long`` have no such bound."""
        limit = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
        if sum(self.sizes.values()) > limit:
            raise ValueError(f"{sum(self.sizes.values())} levels are more columns than spark.sql.pivotMaxValues "
                             f"({limit}) allows; use encode or transform_long")
        cols = [F.col(key), *[F.col(c) for c in keep]]
        cols += [x.alias(name) for x, name in zip(self._fixed(), self._fixed_names())]
        place = {c: i for i, c in enumerate(self.spec.categorical)}
        for r in sorted(self.levels.collect(), key=lambda r: (place[r["column"]], r["position"])):
            hit = F.col(f"{OWN}at_{place[r['column']]}") == r["position"]
            cols.append(F.when(hit, dbl(1)).otherwise(dbl(0)).alias(f"cat_pipeline__{r['column']}_{r['level']}"))
        return self._place(prepare(df)).select(*cols)

    def transform_long(self, df: DataFrame, key: str = "uid") -> DataFrame:
        """Sparse long form (key, feature, value): every numeric/binary value
        and the non-zero one-hot entries."""
        items = [F.struct(F.lit(name).alias("feature"), x.alias("value"))
                 for x, name in zip(self._fixed(), self._fixed_names())]
        for i, c in enumerate(self.spec.categorical):
            items.append(F.when(F.col(f"{OWN}at_{i}").isNotNull(), F.struct(
                F.concat(F.lit(f"cat_pipeline__{c}_"), _cat_input(c)).alias("feature"), dbl(1).alias("value"))))
        return self._place(prepare(df)).select(key, F.explode(F.array(*items)).alias("_f")) \
                   .filter(F.col("_f").isNotNull()).select(key, "_f.feature", "_f.value")

    def encode(self, df: DataFrame, out: str = "features") -> DataFrame:
        """``df`` with a vector column ``out``, sparse where that is smaller;
        entries are those of ``feature_names``."""
        d = self._place(prepare(df))
        fixed = [f"{OWN}x_{i}" for i in range(len(self._fixed()))]
        used = [(i, self.sizes[c]) for i, c in enumerate(self.spec.categorical) if self.sizes[c]]
        # the number of levels goes along as ML's column attribute, so the
        # encoder needs no pass to find it; an unknown level is one past it
        codes = [F.coalesce(F.col(f"{OWN}at_{i}"), F.lit(n)).cast("double").alias(
                     f"{OWN}code_{i}", metadata={"ml_attr": {"type": "nominal", "num_vals": n}}) for i, n in used]
        d = d.select(*df.columns, *[x.alias(c) for x, c in zip(self._fixed(), fixed)], *codes)
        hot = [f"{OWN}hot_{i}" for i, _ in used]
        if hot:
            encoder = OneHotEncoder(inputCols=[f"{OWN}code_{i}" for i, _ in used], outputCols=hot,
                                    handleInvalid="keep", dropLast=True)
            d = encoder.fit(d).transform(d)
        d = VectorAssembler(inputCols=fixed + hot, outputCol=f"{OWN}vector").transform(d)
        kept = [c for c in df.columns if c != out]
        return d.select(*kept, F.col(f"{OWN}vector").alias(out))

    def assemble(self, df: DataFrame, key: str = "uid", out: str = "features",
                 keep: tuple[str, ...] = ()) -> DataFrame:
        return self.encode(prepare(df), out).select(key, *keep, out)

    # ---- persistence (constants as one JSON row, levels as Parquet)
    def save(self, spark, path: str) -> None:
        """Replaces what lies at ``path``; the constants are written last."""
        _write_levels(self.levels, f"{path}/levels")
        doc = json.dumps({"spec": asdict(self.spec), "median_offres": self.median_offres,
                          "mean": self.mean, "scale": self.scale, "sizes": self.sizes})
        spark.createDataFrame([(doc,)], "model string").coalesce(1).write.mode("overwrite").json(f"{path}/constants")

    @staticmethod
    def load(spark, path: str) -> "FeatureModel":
        doc = json.loads(spark.read.json(f"{path}/constants").first()["model"])
        spec = FeatureSpec(*(tuple(doc["spec"][k]) for k in ("numerical", "binary", "categorical")))
        return FeatureModel(spec, doc["median_offres"], _read_levels(spark, f"{path}/levels"),
                            doc["mean"], doc["scale"], doc["sizes"])


def _write_levels(levels: DataFrame, path: str) -> None:
    levels.write.mode("overwrite").partitionBy("column").parquet(path)


def _read_levels(spark, path: str) -> DataFrame:
    return spark.read.schema(LEVELS_SCHEMA).parquet(path)


def _fit_levels(d: DataFrame, columns: tuple[str, ...]) -> tuple[DataFrame, dict[str, int]]:
    """The written levels of ``columns`` and how many each has.  Numbered over
    range partitions: no column's levels meet in one task."""
    spark = d.sparkSession
    pairs = d.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), _cat_input(c).alias("level"))
                                         for c in columns])).alias("_l")) if columns else \
        spark.createDataFrame([], "_l struct<column: string, level: string>")
    ids = dense_ids(pairs, "_l", "_id")
    ends = ids.groupBy("_l.column").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    path = scratch_path(spark, f"levels/{uuid.uuid4().hex[:12]}")
    _write_levels(ids.select("_l.*", "_id").join(F.broadcast(ends), "column")        # ends: a row per column
                     .select("level", (F.col("_id") - F.col("_first")).alias("position"), "column"), path)
    levels = _read_levels(spark, path)
    found = {r["column"]: r["n"] for r in levels.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    return levels, {c: found.get(c, 0) for c in columns}


def fit(train: DataFrame, spec: FeatureSpec) -> FeatureModel:
    """Runs its passes over ``train`` at once: a model is constants and a
    written table of levels."""
    d = prepare(train)
    med = None
    if "offresRecues" in spec.numerical:
        row = exact_quantile_row(d, "offresRecues", [0.5], ["m"]).first()
        med = row["m"] if row else None
    levels, sizes = _fit_levels(d, spec.categorical)
    model = FeatureModel(spec, med, levels, sizes=sizes)
    aggs = []
    for c in spec.numerical:
        x = _num_input(c, med if c == "offresRecues" else None)
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = d.agg(*aggs).first() if aggs else {}
    for c in spec.numerical:
        s = row[f"s_{c}"]
        model.mean[c] = float(row[f"m_{c}"] or 0.0)
        model.scale[c] = 1.0 if (s is None or s == 0.0) else float(s)
    return model


# ---- single steps, as column expressions over learned constants ----------
def impute_median(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    m = exact_quantile_row(train, col, [0.5], ["_m"])
    return df.crossJoin(F.broadcast(m)).withColumn(col, F.coalesce(F.col(col), F.col("_m"))).drop("_m")


def impute_constant(df: DataFrame, numeric=(), binary=(), categorical=()) -> DataFrame:
    fills = {c: 0.0 for c in numeric}
    fills.update({c: 0.0 for c in binary})
    fills.update({c: "missing" for c in categorical})
    return df.fillna(fills)


def scale_standard(train: DataFrame, df: DataFrame, cols) -> DataFrame:
    """(x − mean)/std with the population std learned on train (0 → 1)."""
    st = train.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.crossJoin(F.broadcast(st))   # one row
    out = {c: (F.col(c) - F.col(f"_m_{c}")) /
              F.when((F.col(f"_s_{c}") == 0) | F.col(f"_s_{c}").isNull(), dbl(1)).otherwise(F.col(f"_s_{c}"))
           for c in cols}
    return j.withColumns(out).drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def scale_robust(train: DataFrame, df: DataFrame, col: str) -> DataFrame:
    """(x − median)/(q75 − q25) with exact quantiles learned on train."""
    q = exact_quantile_row(train, col, [0.25, 0.5, 0.75], ["_q1", "_q2", "_q3"])
    iqr = F.col("_q3") - F.col("_q1")
    return df.crossJoin(F.broadcast(q)).withColumn(
        col, (F.col(col) - F.col("_q2")) / F.when(iqr == 0, dbl(1)).otherwise(iqr)).drop("_q1", "_q2", "_q3")


def one_hot(train: DataFrame, df: DataFrame, col: str, key: str = "uid", drop_binary: bool = False) -> DataFrame:
    """One column per level of ``train``; with ``drop_binary`` a column of two
    levels keeps only the second one's (``drop='if_binary'``)."""
    model = fit(train, FeatureSpec((), (), (col,)))
    wide = model.transform(df, key)
    return wide.drop(model.feature_names()[0]) if drop_binary and model.sizes[col] == 2 else wide
