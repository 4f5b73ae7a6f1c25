"""All feature blocks in one vector per text."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkgrain.functions.scalar import FEATURE_NAMES, with_scalar_features
from inkgrain.operators.params import NestedStage, TextParams, named_vector
from inkgrain.operators.rowid import id_faults, require_unique
from inkgrain.operators.terms import by_id


class _Blocks(NestedStage):
    def _fields(self):
        return {"static_col": self.static_col, "static_names": list(self.static_names)}

    def _inner(self):
        return self.blocks

    @classmethod
    def _rebuilt(cls, fields, inner):
        return cls(inner, **fields)


class TextFeatures(Estimator, TextParams, _Blocks):
    """Fits the learned blocks and joins all blocks by id.

    ``blocks`` are unfitted stages, or fitted ones, which are kept as they are (such as a
    vector table read once). Their order is the order of the output features, after the
    scalar block. ``static_col`` names an array column that replaces the scalar block,
    for rows whose unfitted features were computed before.
    """

    def __init__(self, blocks, static_col=None, static_names=(), **params):
        super().__init__()
        self._text_defaults("features")
        self.blocks, self.static_col, self.static_names = list(blocks), static_col, list(static_names)
        self.set(**params)

    def parted(self, static_col: str) -> tuple["TextFeaturesModel", "TextFeatures"] | None:
        """The scalar block with the first blocks that no fit changes, and the stage that takes their features from ``static_col``; ``None`` if it takes them already."""
        if self.static_col:
            return None
        n = next((i for i, b in enumerate(self.blocks) if isinstance(b, Estimator)), len(self.blocks))
        fixed = [b.copy() for b in self.blocks[:n]]
        for block in fixed:
            for name in ("textCol", "idCol", "labelCol"):
                block._set(**{name: self.value(name)})
        static = self._copyValues(TextFeaturesModel(fixed))
        return static, self._copyValues(TextFeatures(self.blocks[n:], static_col, static.get_feature_names_out()))

    def _fit(self, dataset: DataFrame) -> "TextFeaturesModel":
        require_unique(dataset, self.value("idCol"))
        fitted = []
        for block in self.blocks:
            block = block.copy()
            for name in ("textCol", "idCol", "labelCol"):
                block._set(**{name: self.value(name)})
            block.distinct = True
            fitted.append(block.fit(dataset) if isinstance(block, Estimator) else block)
        return self._copyValues(TextFeaturesModel(fitted, self.static_col, self.static_names))


class TextFeaturesModel(Model, TextParams, _Blocks):
    def __init__(self, blocks, static_col=None, static_names=()):
        super().__init__()
        self._text_defaults("features")
        self.blocks, self.static_col = list(blocks), static_col
        self.static_names = list(static_names) if static_col else list(FEATURE_NAMES)

    def get_feature_names_out(self):
        return self.static_names + [n for b in self.blocks for n in b.get_feature_names_out()]

    def array(self, dataset: DataFrame, name: str) -> DataFrame:
        """Append the features as one array.

        If every id names one row, rows are shuffled by id once and keep all their columns: each block whose learned table a task can
        hold is a column beside the text. Other blocks, and all blocks if ids repeat or are null, give their features by id: (id, text)
        is shuffled by id once, all blocks build on that shuffle and the joins add none to it, and only the other columns are shuffled beside it.
        """
        id_col, text_col = self.value("idCol"), self.value("textCol")
        if any(hasattr(b, "beside") for b in self.blocks) and id_faults(dataset, id_col) == (0, 0):
            return self._in_place(dataset, name)
        return self._joined(dataset, name)

    def _in_place(self, dataset: DataFrame, name: str) -> DataFrame:
        id_col, text_col = self.value("idCol"), self.value("textCol")
        others = {c: f"__k{i}" for i, c in enumerate(c for c in dataset.columns if c not in (id_col, text_col))}
        held = [id_col, text_col, *others.values()]
        static = [F.col(self.static_col).alias("__b")] if self.static_col else []
        rows = by_id(dataset.select(id_col, text_col, *[F.col(c).alias(k) for c, k in others.items()], *static), id_col)
        if not static:
            rows = with_scalar_features(rows, text_col).select(*held, F.array(*FEATURE_NAMES).alias("__b"))
        beside = {i: b.beside(F.col(text_col)) for i, b in enumerate(self.blocks) if hasattr(b, "beside")}
        beside = {f"__b{i}": x for i, x in beside.items() if x}
        rows = rows.select("*", *[x.alias(c) for c, (x, _) in beside.items()])
        rows = rows.select(*held, "__b", *[made(F.col(c)).alias(c) for c, (_, made) in beside.items()])
        parts = [F.col("__b")]
        for i, block in enumerate(self.blocks):
            part = F.col(f"__b{i}")
            if f"__b{i}" not in beside:
                rows = rows.join(block.features(dataset).select(id_col, F.col("features").alias(f"__b{i}")), id_col, "left")
                part = F.coalesce(part, F.array_repeat(F.lit(0.0), len(block.get_feature_names_out())))
            parts.append(part)
        return rows.select(*[F.col(others.get(c, c)).alias(c) for c in dataset.columns], F.concat(*parts).alias(name))

    def _joined(self, dataset: DataFrame, name: str) -> DataFrame:
        id_col, text_col, kept = self.value("idCol"), self.value("textCol"), dataset.columns
        if self.static_col:
            rows = by_id(dataset.select(id_col, text_col, F.col(self.static_col).alias("__b")), id_col)
        else:
            slim = by_id(dataset.select(id_col, text_col), id_col)
            scalars = with_scalar_features(slim, text_col)
            rows = scalars.select(id_col, text_col, F.array(*FEATURE_NAMES).alias("__b"))
        parts = [F.col("__b")]
        for i, block in enumerate(self.blocks):
            found = block.features(dataset).select(id_col, F.col("features").alias(f"__b{i}"))
            rows = rows.join(found, id_col, "left")
            width = len(block.get_feature_names_out())
            parts.append(F.coalesce(F.col(f"__b{i}"), F.array_repeat(F.lit(0.0), width)))
        features = rows.select(id_col, text_col, F.concat(*parts).alias(name))
        others = [c for c in kept if c not in (id_col, text_col)]
        if others:
            features = dataset.select(id_col, *others).join(features, id_col, "left")
        return features.select(*[F.col(c) for c in kept], name)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector, metadata = named_vector(F.col("__f"), self.get_feature_names_out())
        rows = self.array(dataset, "__f")
        return rows.select(*[F.col(c) for c in dataset.columns], vector.alias(self.value("outputCol"), metadata=metadata))
