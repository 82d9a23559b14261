"""Feature columns to numbers: bucket ids, hash ids, hashed crosses, wide vector positions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import accumulate, chain

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.functions.buckets import even_bucket_guess_sql, even_bucket_sql
from clickloom.functions.hashing import CROSS_FACTOR, PORTABLE, bucket_sql, cross_sql, hash32_sql

# Selected features and their hash bucket counts.
HASH_SIZES = {
    "fea9": 500,
    "fea15": 20000,
    "fea16": 1000,
    "fea17": 100,
    "fea18": 100,
    "fea22": 5,
    "fea23": 200,
    "fea24": 2000,
    "fea2": 100,
    "fea1": 50,
    "fea7": 50,
}

# First edge, last edge and number of even edges of the bucketized features.
EVEN_EDGES = {
    "fea9": (1000, 5000000, 1000),
    "fea16": (0, 2147483647, 1000),
    "fea18": (0, 2147483647, 500),
    "fea22": (0, 10, 5),
    "fea23": (0, 150, 150),
    "fea15": (0, 2147483647, 20000),
    "fea2": (0, 10000000, 100),
    "fea1": (0, 200, 100),
    "fea17": (0, 20000, 10),
    "fea7": (0, 50, 10),
}

# Crossed pairs and their hash bucket counts.
CROSS_SIZES = {
    ("fea9", "fea16"): 20000,
    ("fea9", "fea15"): 4000000,
    ("fea9", "fea18"): 50000,
    ("fea9", "fea22"): 2000,
    ("fea9", "fea23"): 20000,
    ("fea15", "fea22"): 50000,
    ("fea15", "fea23"): 1000000,
    ("fea18", "fea22"): 1000,
    ("fea18", "fea23"): 200000,
    ("fea22", "fea23"): 500,
    ("fea2", "fea15"): 500000,
    ("fea1", "fea15"): 200000,
    ("fea7", "fea15"): 200000,
    ("fea2", "fea22"): 500,
    ("fea2", "fea23"): 5000,
    ("fea1", "fea22"): 100,
    ("fea1", "fea23"): 1000,
    ("fea7", "fea22"): 50,
    ("fea2", "fea17"): 500,
    ("fea1", "fea17"): 500,
    ("fea7", "fea17"): 100,
    ("fea2", "fea18"): 5000,
}

# Features of the bucketized model's deep part.
DEEP_NUMERIC = ["fea23", "fea22", "fea24", "fea7", "fea1", "fea16"]

#: Width of the dense form of each categorical feature.
EMBEDDING_WIDTH = 8

@dataclass(frozen=True)
class EncoderSpec:
    """Which columns are hashed, bucketed and crossed, and by which hash.

    The encodings are SQL text in layers: a layer reads the columns of the ones
    before it, so each value is hashed once however many ids use it.
    """

    hashed: Mapping[str, int] = field(default_factory=lambda: dict(HASH_SIZES))
    crossed: Mapping[tuple[str, str], int] = field(default_factory=lambda: dict(CROSS_SIZES))
    edges: Mapping[str, tuple[float, float, int]] = field(default_factory=lambda: dict(EVEN_EDGES))
    method: str = PORTABLE

    def _hashes(self, columns: Iterable[str]) -> dict[str, str]:
        return {f"_h_{c}": hash32_sql(f"coalesce(cast(`{c}` as string), '')", self.method) for c in columns}

    def hashes(self) -> dict[str, str]:
        """Layer of value hashes for :meth:`hash_ids` and :meth:`cross_ids`."""
        return self._hashes(dict.fromkeys([*self.hashed, *chain.from_iterable(self.crossed)]))

    def hash_ids(self) -> dict[str, str]:
        """Hash id of each feature."""
        return {f"{c}_id": bucket_sql(f"_h_{c}", n) for c, n in self.hashed.items()}

    def cross_ids(self) -> dict[str, str]:
        """Hash id of each crossed pair of raw features."""
        return {f"{a}_x_{b}": cross_sql(f"_h_{a}", f"_h_{b}", n) for (a, b), n in self.crossed.items()}

    def bucket_values(self) -> dict[str, str]:
        return {f"_v_{c}": f"cast(`{c}` as double)" for c in self.edges}

    def bucket_guesses(self) -> dict[str, str]:
        return {f"_g_{c}": even_bucket_guess_sql(f"_v_{c}", *edge) for c, edge in self.edges.items()}

    def bucket_ids(self) -> dict[str, str]:
        """Bucket id of each feature that has edges."""
        return {f"{c}_bucket": even_bucket_sql(f"_g_{c}", f"_v_{c}", *edge) for c, edge in self.edges.items()}

    def bucket_hashes(self) -> dict[str, str]:
        return self._hashes(f"{c}_bucket" for c in dict.fromkeys(chain.from_iterable(self.crossed)))

    def bucket_cross_ids(self) -> dict[str, str]:
        """Hash id of each crossed pair of bucket ids."""
        return {
            f"{a}_bx_{b}": cross_sql(f"_h_{a}_bucket", f"_h_{b}_bucket", n) for (a, b), n in self.crossed.items()
        }

    def sizes(self) -> list[int]:
        return [*self.hashed.values(), *self.crossed.values()]

    def width(self) -> int:
        """Length of the wide vector."""
        return sum(self.sizes())

    def offsets(self) -> list[int]:
        """First wide position of every hashed and crossed column."""
        return [0, *accumulate(self.sizes())][:-1]

    def places(self) -> Callable[[np.ndarray], Iterator[np.ndarray]]:
        """Makes the wide positions of rows, column by column, of the columns of :meth:`hashes` (in their order, 32 bits each).

        Workers get it whole and need not find this package.
        """
        at = {c: i for i, c in enumerate(dict.fromkeys([*self.hashed, *chain.from_iterable(self.crossed)]))}
        terms = [(at[c], None, n) for c, n in self.hashed.items()] + [(at[a], at[b], n) for (a, b), n in self.crossed.items()]
        listed, factor = [(*term, start) for term, start in zip(terms, self.offsets(), strict=True)], CROSS_FACTOR

        def made(hashes: np.ndarray) -> Iterator[np.ndarray]:
            whole = hashes.astype(np.uint64)
            for a, b, n, start in listed:
                value = whole[a] if b is None else whole[a] * np.uint64(factor) + whole[b]
                rounds = value // np.uint64(n)  # quicker than a remainder
                rounds *= np.uint64(n)
                place = np.subtract(value, rounds, out=rounds)
                place += np.uint64(start)
                yield place.view(np.int64)

        return made


def _layered(rows: DataFrame, *layers: Mapping[str, str]) -> DataFrame:
    """Add the layers one on top of the other; names with a leading underscore do not stay."""
    kept = list(rows.columns)
    for layer in layers[:-1]:
        rows = rows.selectExpr("*", *[f"{sql} as `{name}`" for name, sql in layer.items()])
        kept += [name for name in layer if not name.startswith("_")]
    return rows.selectExpr(*[f"`{c}`" for c in kept], *[f"{sql} as `{name}`" for name, sql in layers[-1].items()])


def _in_small_methods(array: str) -> str:
    """The same array. Spark cuts the code of a projection with a lambda into methods, each small enough to be compiled,
    in any session; without, one method holds all ids and stays interpreted unless ``hugeMethodLimit`` is lowered."""
    return f"transform({array}, p -> p)"


def add_hash_ids(rows: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    return _layered(rows, spec.hashes(), spec.hash_ids())


def add_cross_ids(rows: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    return _layered(rows, spec.hashes(), spec.cross_ids())


def add_bucket_ids(rows: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    return _layered(rows, spec.bucket_values(), spec.bucket_guesses(), spec.bucket_ids())


def add_bucket_cross_ids(rows: DataFrame, spec: EncoderSpec = EncoderSpec()) -> DataFrame:
    """Bucket both features of a pair, then hash the pair of bucket ids."""
    return _layered(add_bucket_ids(rows, spec), spec.bucket_hashes(), spec.bucket_cross_ids())


def add_wide_positions(rows: DataFrame, spec: EncoderSpec = EncoderSpec(), name: str = "wide") -> DataFrame:
    """Array of the positions that are 1 in the wide vector, ascending: offset plus id of each column."""
    ids = [*spec.hash_ids().values(), *spec.cross_ids().values()]
    positions = [f"{start}L + {sql}" for start, sql in zip(spec.offsets(), ids, strict=True)]
    return _layered(rows, spec.hashes(), {name: _in_small_methods(f"array({', '.join(positions)})")})


def positions_statement(spec: EncoderSpec, name: str) -> str:
    """All columns and the wide positions as one SQL statement over ``__THIS__``, for a pipeline stage."""
    hashes = ", ".join(f"{sql} as `{c}`" for c, sql in spec.hashes().items())
    ids = [*spec.hash_ids().values(), *spec.cross_ids().values()]
    places = ", ".join(f"{start}L + {sql}" for start, sql in zip(spec.offsets(), ids, strict=True))
    return f"select *, {_in_small_methods(f'array({places})')} as `{name}` from (select *, {hashes} from __THIS__)"


def encode_statement(spec: EncoderSpec, crosses: bool) -> str:
    """The ids as one SQL statement over ``__THIS__``, for a pipeline stage."""
    ids = {**spec.hash_ids(), **(spec.cross_ids() if crosses else {})}

    def listed(columns: Mapping[str, str]) -> str:
        return ", ".join(f"{sql} as `{name}`" for name, sql in columns.items())

    return f"select *, {listed(ids)} from (select *, {listed(spec.hashes())} from __THIS__)"


def numeric(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numeric features as doubles; text that is no number becomes NULL."""
    return rows.withColumns({c: F.col(c).try_cast("double") for c in columns})


def bucketize(rows: DataFrame, column: str, edges: Sequence[float], name: str) -> DataFrame:
    """Left-closed bucket ids for edges that are not even."""
    splits = [float("-inf"), *[float(e) for e in edges], float("inf")]
    stage = Bucketizer(splits=splits, inputCol=column, outputCol=name, handleInvalid="keep")
    return stage.transform(rows.withColumn(column, F.col(column).cast("double"))).withColumn(
        name, F.col(name).cast("int")
    )
