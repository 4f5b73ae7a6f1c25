"""Shared parameters and persistence of the pipeline stages."""

from __future__ import annotations

import importlib

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class TextParams(Params):
    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "unique key of a row", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    def _text_defaults(self, output: str) -> None:
        self._setDefault(textCol="TEXT", idCol="id", labelCol="LABEL", outputCol=output)

    def value(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def set(self, *args, **params):
        if args:
            return super().set(*args)
        self._set(**params)
        return self


class TableWriter(MLWriter):
    """Parameters and small fields as metadata, tables as Parquet next to them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, self.stage._fields())
        for name, table in self.stage._tables().items():
            table.write.parquet(f"{path}/{name}")


class TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tables = {name: self.sparkSession.read.parquet(f"{path}/{name}") for name in self.cls._table_names}
        stage = self.cls(**{name: metadata[name] for name in self.cls._field_names}, **tables)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class TableModel(MLWritable, MLReadable):
    """Mix-in: ``_field_names`` and ``_table_names`` say what a model consists of."""

    _field_names: tuple[str, ...] = ()
    _table_names: tuple[str, ...] = ()

    def _fields(self):
        return {n: getattr(self, n) for n in self._field_names}

    def _tables(self):
        return {n: getattr(self, n) for n in self._table_names}

    def write(self):
        return TableWriter(self)

    def save(self, path: str) -> None:
        self.write().save(path)

    @classmethod
    def read(cls):
        return TableReader(cls)

    @classmethod
    def load(cls, path: str):
        return cls.read().load(path)


class NestedWriter(MLWriter):
    """Parameters and plain fields as metadata, the stages inside in folders next to them."""

    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        inner = self.stage._inner()
        kinds = [f"{type(x).__module__}:{type(x).__name__}" for x in inner]
        extra = {"fields": self.stage._fields(), "kinds": kinds}
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession, extra)
        for i, stage in enumerate(inner):
            stage.save(f"{path}/inner/{i:05d}")


class NestedReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        inner = []
        for i, kind in enumerate(metadata["kinds"]):
            module, name = kind.split(":")
            inner.append(getattr(importlib.import_module(module), name).load(f"{path}/inner/{i:05d}"))
        stage = self.cls._rebuilt(metadata["fields"], inner)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage


class NestedStage(MLWritable, MLReadable):
    """Mix-in for stages that hold plain fields and other stages."""

    def _fields(self) -> dict:
        return {}

    def _inner(self) -> list:
        return []

    @classmethod
    def _rebuilt(cls, fields: dict, inner: list):
        return cls(**fields)

    def write(self):
        return NestedWriter(self)

    @classmethod
    def read(cls):
        return NestedReader(cls)


def named_vector(array_column, names):
    """A vector column whose metadata carries the feature names."""
    from pyspark.ml.functions import array_to_vector

    attributes = [{"idx": i, "name": n} for i, n in enumerate(names)]
    return array_to_vector(array_column), {"ml_attr": {"attrs": {"numeric": attributes}, "num_attrs": len(names)}}
