"""Vocabularies, facet configurations, rules and source registries as files.

A configuration is a JSON object whose entries are the fields of its class, all of them optional; an entry that the class lacks, or a value
of another kind, is an error that names its place. Configurations are bounded by what people write, and are read on the driver as one
row; vocabularies beyond that are tables (`operators/vocabulary_tables.py`). A source registry is a table.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from types import NoneType, UnionType
from typing import Any, TypeVar, Union, get_args, get_origin, get_type_hints

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scoring import Lexicon
from ..operators.vocabulary_tables import BROADCAST_TERMS, normal_vocabulary
from .readers import SOURCE

C = TypeVar("C")


class ConfigError(ValueError):
    """A configuration that does not fit its class, or a registry whose names do not tell its sources apart."""


def _build(kind: Any, value: Any, at: str) -> Any:
    origin, own = get_origin(kind), get_args(kind)
    if origin in (Union, UnionType):
        return None if value is None and NoneType in own else _build(next(a for a in own if a is not NoneType), value, at)
    if dataclasses.is_dataclass(kind):
        if not isinstance(value, dict):
            raise ConfigError(f"{at}: an object is needed")
        hints = get_type_hints(kind)
        if odd := sorted(set(value) - set(hints)):
            raise ConfigError(f"{at}: unknown entries {', '.join(odd)}")
        lacking = [f.name for f in dataclasses.fields(kind) if f.name not in value and f.default is f.default_factory is dataclasses.MISSING]
        if lacking:
            raise ConfigError(f"{at}: entries {', '.join(lacking)} are missing")
        return kind(**{k: _build(hints[k], v, f"{at}.{k}") for k, v in value.items()})
    if origin is dict:
        if not isinstance(value, dict):
            raise ConfigError(f"{at}: an object is needed")
        return {k: _build(own[1], v, f"{at}.{k}") for k, v in value.items()}
    if origin in (tuple, frozenset):
        if not isinstance(value, list):
            raise ConfigError(f"{at}: an array is needed")
        kinds = [own[0]] * len(value) if origin is frozenset or own[-1] is Ellipsis else list(own)
        if len(kinds) != len(value):
            raise ConfigError(f"{at}: {len(kinds)} values are needed")
        return origin(_build(k, v, f"{at}[{i}]") for i, (k, v) in enumerate(zip(kinds, value)))
    if type(value) is not kind:  # a boolean is no number here
        raise ConfigError(f"{at}: {kind.__name__} is needed, not {type(value).__name__}")
    return value


def _plain(value: Any) -> Any:
    if dataclasses.is_dataclass(value):
        return {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
    if isinstance(value, dict):
        return {k: _plain(v) for k, v in value.items()}
    if isinstance(value, frozenset):
        return sorted(map(_plain, value))
    return [_plain(v) for v in value] if isinstance(value, (tuple, list)) else value


def to_json(config: Any) -> str:
    return json.dumps(_plain(config), ensure_ascii=False, indent=1)


def from_json(kind: type[C], told: str) -> C:
    try:
        value = json.loads(told)
    except json.JSONDecodeError as e:
        raise ConfigError(f"{kind.__name__}: not JSON: {e}") from None
    return _build(kind, value, kind.__name__)


def read_config(spark: SparkSession, path: str, kind: type[C]) -> C:
    """A Lexicon, FacetConfig or Rules of one JSON file, wherever Spark can read."""
    found = spark.read.text(path, wholetext=True).take(2)
    if len(found) != 1:
        raise ConfigError(f"{path} has to be one file that is not empty")
    return from_json(kind, found[0][0])


def fingerprint(config: Any) -> str:
    """The same for configurations that say the same, whatever the order of their entries."""
    return hashlib.sha256(json.dumps(_plain(config), ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:32]


def with_table(lexicon: Lexicon, vocabulary: DataFrame, most: int = BROADCAST_TERMS) -> Lexicon:
    """The lexicon with the lists of a vocabulary table (list_id, ord, term) as its sets of those names, in their order.

    A table of more than `most` terms is refused: one of that size is matched by joins.
    """
    found = normal_vocabulary(vocabulary).select("list_id", "ord", "term").limit(most + 1).collect()
    if len(found) > most:
        raise ConfigError(f"more than {most} terms; match them by joins")
    sets: dict[str, list[str]] = {}
    for list_id, _, term in sorted(found, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        sets.setdefault(list_id, []).append(term)
    return dataclasses.replace(lexicon, sets=lexicon.sets | {k: tuple(v) for k, v in sets.items()})


def registry(spark: SparkSession, path: str) -> DataFrame:
    """The sources of JSON lines or of JSON arrays of objects, one row each; ConfigError if one has no name or the name of another.

    Missing fields are null, unknown ones are left out.
    """
    df = spark.read.schema(SOURCE).option("multiLine", False).json(path)
    if not df.where("name IS NULL").isEmpty():  # arrays that span lines
        df = spark.read.schema(SOURCE).option("multiLine", True).json(path)
    odd = df.groupBy("name").count().where("name IS NULL OR trim(name) = '' OR count > 1").orderBy("name").take(5)
    if odd:
        raise ConfigError("sources without a name, or with that of others: " + ", ".join(str(r["name"]) for r in odd))
    return df
