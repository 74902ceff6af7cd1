"""Model sink and source (S7): one parquet table per model table plus a
one-row params table; ``fit_or_load`` trains only when nothing is stored."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators.bias import BiasModel
from ..operators.factor import FactorModel
from ..operators.fm import FmModel
from ..operators.fm_ctr import GbdtLrModel


@dataclass
class TableModel:
    """Any trained state that is a set of tables, e.g. a similarity table for
    the neighbourhood predictors: {"sims": (i, j, sim)} plus parameters."""
    tables_: dict[str, DataFrame]
    params: dict = field(default_factory=dict)

    def tables(self) -> dict[str, DataFrame]:
        return self.tables_


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def save_tables(spark: SparkSession, path: str, tables: dict[str, DataFrame], params: dict) -> None:
    base = path.rstrip("/")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
    spark.createDataFrame([(json.dumps(params, default=str),)], "params string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{base}/_params")


def load_tables(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], dict]:
    base = path.rstrip("/")
    params = json.loads(spark.read.parquet(f"{base}/_params").first()["params"])
    tables = {name: spark.read.parquet(f"{base}/{name}") for name in params["_tables"]}
    return tables, params


def save_model(model, path: str) -> None:
    """BiasModel, FactorModel, FmModel, TableModel or GbdtLrModel -> parquet directory."""
    if isinstance(model, BiasModel):
        spark = model.item_bias.sparkSession
        params = {"_kind": "bias", "mu": model.mu, "params": model.params}
        tables = model.tables()
    elif isinstance(model, FactorModel):
        spark = model.user_factors.sparkSession
        params = {"_kind": "factor", "k": model.k, "mu": model.mu, "link": model.link, "params": model.params,
                  "has_bias": model.bias is not None}
        tables = model.tables()
        if model.bias is not None:
            tables = {**tables, "bias_item": model.bias.item_bias, "bias_user": model.bias.user_bias}
            params["bias_mu"] = model.bias.mu
            params["bias_params"] = model.bias.params
    elif isinstance(model, FmModel):
        spark = model.weights.sparkSession
        params = {"_kind": "fm", "k": model.k, "columns": list(model.slots), "params": model.params}
        tables = model.tables()
    elif isinstance(model, TableModel):
        spark = next(iter(model.tables_.values())).sparkSession
        params = {"_kind": "tables", "params": model.params}
        tables = model.tables()
    elif isinstance(model, GbdtLrModel):
        spark = SparkSession.getActiveSession()
        params = {"_kind": "gbdt_lr", "model": model.to_dict()}
        tables = {}
    else:
        raise TypeError(f"cannot save {type(model).__name__}")
    params["_tables"] = list(tables)
    save_tables(spark, path, tables, params)


def load_model(spark: SparkSession, path: str):
    tables, params = load_tables(spark, path)
    if params["_kind"] == "bias":
        return BiasModel(params["mu"], tables["item_bias"], tables["user_bias"], params["params"])
    if params["_kind"] == "gbdt_lr":
        return GbdtLrModel.from_dict(params["model"])
    if params["_kind"] == "fm":
        return FmModel({c: tables[f"slots_{c}"] for c in params["columns"]}, tables["weights"], params["k"], params["params"])
    if params["_kind"] == "tables":
        return TableModel(tables, params["params"])
    bias = None
    if params.get("has_bias"):
        bias = BiasModel(params["bias_mu"], tables["bias_item"], tables["bias_user"], params["bias_params"])
    return FactorModel(tables["user_factors"], tables["item_factors"], params["k"], params["mu"], bias,
                       params["link"], params["params"])


def fit_or_load(spark: SparkSession, path: str | None, fit: Callable[[], object]):
    """Load the model stored at ``path`` if there is one; else fit, then save."""
    if path and path_exists(spark, f"{path.rstrip('/')}/_params"):
        return load_model(spark, path)
    model = fit()
    if path:
        save_model(model, path)
    return model
