"""Save and load fitted models (the ``MLWritable`` role) on a shared file system.

``write_stage``/``read_stage`` serve Spark's own writers and readers (a stage in
a ``pyspark.ml.Pipeline``); ``save_model``/``load_model`` take any object of the
library.  A model's small state (scalars, dictionaries, coefficient arrays, nested fitted
models) is written as one JSON row through Spark; DataFrame-valued state
(lookup tables too large to inline) is written as Parquet next to it.  Paths
are whatever the cluster shares (the same place as ``spark.checkpoint.dir``).
Spark ML models inside (the GBT wrapper) use Spark's own ``save``/``load``.
"""

from __future__ import annotations

import importlib
import json

import numpy as np
from pyspark.ml.param import Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, JavaMLWritable
from pyspark.sql import DataFrame, SparkSession

_SKIP = {"_paramMap", "_defaultParamMap", "_params", "uid", "_input_kwargs", "_own", "_index"}  # _index: built anew when needed


def _encode(value, frames: dict, prefix: str):
    if isinstance(value, DataFrame):
        key = f"{prefix}_{len(frames)}"
        frames[key] = value
        return {"__frame__": key}
    if isinstance(value, JavaMLWritable):  # a Spark ML model or transformer saves itself
        key = f"ml_{len(frames)}"
        frames[key] = value
        return {"__ml__": key, "class": f"{type(value).__module__}:{type(value).__qualname__}"}
    if isinstance(value, np.ndarray):
        return {"__ndarray__": value.tolist()}
    if isinstance(value, (np.floating, np.integer)):
        return value.item()
    if isinstance(value, dict):
        return {"__dict__": [[_encode(k, frames, prefix), _encode(v, frames, prefix)] for k, v in value.items()]}
    if isinstance(value, (list, tuple)):
        return {"__list__": [_encode(v, frames, prefix) for v in value], "tuple": isinstance(value, tuple)}
    if hasattr(value, "__dict__") and type(value).__module__.startswith("tabforge"):
        return {"__object__": f"{type(value).__module__}:{type(value).__qualname__}",
                "state": {k: _encode(v, frames, prefix) for k, v in _state(value).items()}}
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    raise TypeError(f"cannot save {type(value).__name__}")


def _state(value) -> dict:
    """Plain attributes and Params of an object, by name."""
    state = {k: v for k, v in vars(value).items() if k not in _SKIP}
    if isinstance(value, Params):
        state |= {p.name: v for p, v in value._paramMap.items()}
    return state


def _class(name: str, package: str):
    """The class of a saved object; only classes of ``package`` are ever loaded."""
    mod, qual = name.split(":")
    if mod != package and not mod.startswith(package + "."):
        raise ValueError(f"{mod} is not part of {package}")
    cls = importlib.import_module(mod)
    for part in qual.split("."):
        cls = getattr(cls, part)
    return cls


def _decode(value, frames: dict):
    if isinstance(value, dict):
        if "__ml__" in value:
            return frames[value["__ml__"]]
        if "__frame__" in value:
            return frames[value["__frame__"]]
        if "__ndarray__" in value:
            return np.asarray(value["__ndarray__"], dtype=float)
        if "__dict__" in value:
            return {_decode(k, frames): _decode(v, frames) for k, v in value["__dict__"]}
        if "__list__" in value:
            items = [_decode(v, frames) for v in value["__list__"]]
            return tuple(items) if value.get("tuple") else items
        if "__object__" in value:
            cls = _class(value["__object__"], "tabforge")
            obj = cls.__new__(cls)
            if isinstance(obj, Params):  # pyspark Params bookkeeping (uid, param maps)
                Params.__init__(obj)
            for k, v in value["state"].items():
                object.__setattr__(obj, k, _decode(v, frames))  # frozen dataclasses too; Params go to the param map
            return obj
    return value


def _write_frames(frames: dict, path: str) -> None:
    for key, frame in frames.items():
        if isinstance(frame, DataFrame):
            frame.write.mode("overwrite").parquet(f"{path}/{key}")
        else:
            frame.write().overwrite().save(f"{path}/{key}")


def write_stage(stage: Params, path: str, spark: SparkSession) -> None:
    """A stage in Spark's layout: its metadata file, whose ``state`` holds Params and fitted state, and its tables."""
    frames: dict = {}
    doc = _encode(stage, frames, "frame")
    DefaultParamsWriter.saveMetadata(stage, path, spark, extraMetadata={"state": doc}, paramMap={})
    _write_frames(frames, path)


def read_stage(path: str, spark: SparkSession, cls: type):
    metadata = DefaultParamsReader.loadMetadata(path, spark)
    stage = _restore(metadata["state"], path, spark)
    if not isinstance(stage, cls):
        raise TypeError(f"{path} holds a {type(stage).__name__}, not a {cls.__name__}")
    return stage._resetUid(metadata["uid"])


def save_model(model, path: str, spark: SparkSession) -> str:
    frames: dict = {}
    doc = json.dumps(_encode(model, frames, "frame"))
    spark.createDataFrame([(doc,)], "state string").coalesce(1).write.mode("overwrite").parquet(f"{path}/state")
    _write_frames(frames, path)
    return path


def load_model(path: str, spark: SparkSession):
    return _restore(json.loads(spark.read.parquet(f"{path}/state").first()["state"]), path, spark)


def _restore(doc, path: str, spark: SparkSession):
    keys, ml = set(), {}

    def collect(v):
        if isinstance(v, dict):
            if "__frame__" in v:
                keys.add(v["__frame__"])
            if "__ml__" in v:
                ml[v["__ml__"]] = v["class"]
            for x in v.values():
                collect(x)
        elif isinstance(v, list):
            for x in v:
                collect(x)
    collect(doc)
    frames = {k: spark.read.parquet(f"{path}/{k}") for k in keys}
    frames |= {k: _class(c, "pyspark.ml").load(f"{path}/{k}") for k, c in ml.items()}
    return _decode(doc, frames)
