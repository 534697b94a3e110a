"""Dataset contracts: canonical columns, tags, types, aliases, keys and quality rules."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

INTEGER = "bigint"
AMOUNT, DATE, KEY, ID, CODE, NAME, FLAG, COUNT, RATE, OTHER = (
    "amount", "date", "key", "id", "code", "name", "flag", "count", "rate", "other",
)
KEEP, FILL_ZERO, FILL_EMPTY, FAIL_ON_NULL = "keep_nan", "fill_zero", "fill_empty", "fail_on_nan"
TAG_TYPES = {AMOUNT: "decimal(18,2)", DATE: "timestamp_ntz", RATE: "double", FLAG: "bigint", COUNT: "bigint"}


@dataclass(frozen=True)
class Field:
    name: str
    tag: str = OTHER
    required: bool = False
    aliases: tuple[str, ...] = ()
    fill: str = KEEP
    dtype: str = ""

    @property
    def spark_type(self) -> str:
        return self.dtype or TAG_TYPES.get(self.tag, "string")


@dataclass(frozen=True)
class Contract:
    dataset_id: str
    version: int
    fields: tuple[Field, ...]
    primary_keys: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        check_alias_collisions(self)

    @property
    def content_hash(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def check_alias_collisions(contract: Contract) -> None:
    """An alias may name one field only, and not be another field's canonical name."""
    owner: dict[str, str] = {f.name: f.name for f in contract.fields}
    for f in contract.fields:
        for alias in f.aliases:
            key = alias.strip()
            if owner.setdefault(key, f.name) != f.name:
                raise ValueError(f"{contract.dataset_id}: alias {alias!r} names both {owner[key]} and {f.name}")
