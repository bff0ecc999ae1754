"""``pyspark.ml`` base classes of the column operators.

An operator is an ``Estimator``, ``Model`` or ``Transformer`` and works as a
stage of ``pyspark.ml.Pipeline``, in ``ParamGridBuilder`` and in
``CrossValidator``.  The constructor arguments of an estimator or transformer
are its Params: ``stage.alpha`` is the value, ``stage.getParam("alpha")`` the
``Param``; values live in Spark's param map, so ``copy({param: value})``,
``fit(df, {param: value})``, ``extractParamMap`` and ``explainParams`` see them.
Models keep their fitted state as plain attributes: small driver-side values,
or DataFrames for state that grows with the data.

Every operator saves and loads through Spark (``stage.write().save(path)``,
``Class.load(path)``, ``Pipeline.save``): Params and small state as JSON in
Spark's metadata file, DataFrames as Parquet beside it (``operators/persist``).
"""

from __future__ import annotations

import copy as _copy
import inspect

from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dictionaries larger than this are joined as DataFrames instead of being inlined as
# literal maps in the plan: a map lookup is a linear scan.  Both forms give the same table.
MAX_LITERAL_ENTRIES = 64
# Row bound under which a fitted lookup table is broadcast (its count is checked at fit).
MAX_BROADCAST_ROWS = 500_000


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        from tabforge.operators.persist import write_stage
        write_stage(self.instance, path, self.sparkSession)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        from tabforge.operators.persist import read_stage
        return read_stage(path, self.sparkSession, self.cls)


class _Stored(MLReadable, MLWritable):
    """Saved and loaded through Spark."""

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Value:
    """Attribute of a stage whose value is that of the Param of the same name."""

    def __init__(self, name: str):
        self.name = name

    def __get__(self, stage, owner=None):
        if stage is None:
            return self
        param = stage._own[self.name]
        try:
            return stage._paramMap[param]
        except KeyError:
            raise AttributeError(f"{self.name} is not set") from None

    def __set__(self, stage, value):
        stage._paramMap[stage._own[self.name]] = value


class _Configured(_Stored):
    """The constructor arguments of a subclass become its Params."""

    _param_names: tuple = ()

    def __init_subclass__(cls, **kwargs):
        super().__init_subclass__(**kwargs)
        names = list(cls._param_names)
        for name in [p for p in inspect.signature(cls.__init__).parameters if p != "self"] + list(cls.__dict__.get("also_params", ())):
            if name not in names and not hasattr(cls, name):  # ``params`` itself is taken by Spark
                setattr(cls, name, _Value(name))
                names.append(name)
        cls._param_names = tuple(names)

    def _copy_params(self):
        super()._copy_params()
        self._own = {n: Param(self, n, f"constructor argument {n} of {type(self).__name__}") for n in self._param_names}

    @property
    def params(self) -> list:
        return [self._own[n] for n in sorted(self._own)]

    def hasParam(self, paramName: str) -> bool:
        return paramName in self._own

    def getParam(self, paramName: str) -> Param:
        if paramName not in self._own:
            raise ValueError(f"Cannot find param with name {paramName}.")
        return self._own[paramName]

    def _set(self, **kwargs):
        for name, value in kwargs.items():
            self._paramMap[self.getParam(name)] = value
        return self


class ColumnEstimator(_Configured, Estimator):
    def __init__(self):
        super().__init__()

    def _fit(self, dataset: DataFrame):  # pragma: no cover - abstract
        raise NotImplementedError


class ColumnModel(_Stored, Model):
    def __init__(self):
        super().__init__()

    def copy(self, extra=None):  # noqa: D102 - pyspark API; fitted state is shared
        return _copy.copy(self)


class ColumnTransformer(_Configured, Transformer):
    def __init__(self):
        super().__init__()


def checked_broadcast(lookup: DataFrame, n_rows: int, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast a fitted lookup only when its counted size is under the bound."""
    return F.broadcast(lookup) if n_rows <= max_rows else lookup
