"""What a table is called, where it is staged, and who may read it."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

# Names and paths the staging contract prescribes.
SOURCE_SCHEMA_PREFIX = "gis_"
TEST_SCHEMA_SUFFIX = "_test"
STAGING_PATH = "staging/{schema}/{table}.csv"
SIDECAR_PATH = "schemas/{schema}/{table}.json"
REJECTS_PATH = "rejects/{schema}/{table}"
DIGIT_WORDS = {
    "1": "one",
    "2": "two",
    "3": "three",
    "4": "four",
    "5": "five",
    "6": "six",
    "7": "seven",
    "8": "eight",
    "9": "nine",
}

# Keys of the YAML table configs.
CONFIG_PUBLISH = "upload_to_carto"
CONFIG_READERS = "carto_users"
CONFIG_KEYS = "indexes"
CONFIG_OBJECT_ID = "knack_object_id"
CONFIG_SOURCE = "knack_conn_id"
CONFIG_TARGET = "carto_conn_id"

PRODUCTION = "production"
TEST = "test"
#: "test" as a word of its own: ``latest`` and ``contest`` are no test sources.
TEST_WORD = re.compile(r"(?<![a-z0-9])test(?![a-z0-9])", re.IGNORECASE)

# Side tables of a warehouse load.
LOADING = "loading"
PREVIOUS = "previous"
WORKING_NAME = re.compile(rf"(.+)__({LOADING}|{PREVIOUS})_[0-9a-f]{{8}}")


def working_name(table: str, kind: str) -> str:
    """A new name for a side table of ``table``."""
    return f"{table}__{kind}_{uuid.uuid4().hex[:8]}"


def is_working_name(name: str, table: str, kind: str) -> bool:
    match = WORKING_NAME.fullmatch(name)
    return bool(match) and match[1].lower() == table.lower() and match[2] == kind


def quote(identifier: str) -> str:
    """An identifier as SQL text, whatever characters it has."""
    return "`" + identifier.replace("`", "``") + "`"


def spell_schema_name(name: str) -> str:
    """``311`` becomes ``threeoneone``; a name that is not all digits is kept.

    A digit name with a zero has no agreed spelling and is refused.
    """
    if not (name.isascii() and name.isdigit()):
        return name
    if "0" in name:
        raise ValueError(f"schema name {name!r} has a zero, which has no spelling")
    return "".join(DIGIT_WORDS[digit] for digit in name)


@dataclass(frozen=True)
class TableSpec:
    """One table of a full-refresh run.

    ``schema`` and ``table`` identify it everywhere. ``keys`` are the columns
    readers look rows up by, the most used first; ``readers`` are recorded on
    the published table. ``environment`` is ``production`` or ``test``; a test
    table lives under the schema name with the test suffix. ``target`` names
    the serving area a config asks for, if it does; the caller resolves it.
    """

    schema: str
    table: str
    publish: bool = True
    readers: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    environment: str = PRODUCTION
    object_id: int | None = None
    target: str | None = None

    def __post_init__(self) -> None:
        if not self.schema or not self.table:
            raise ValueError("schema and table must not be empty")
        if WORKING_NAME.fullmatch(self.table):
            raise ValueError(f"{self.table!r} is the name of a side table")
        if self.environment not in (PRODUCTION, TEST):
            raise ValueError(f"unknown environment {self.environment!r}")

    @property
    def target_schema(self) -> str:
        suffix = TEST_SCHEMA_SUFFIX if self.environment == TEST else ""
        return self.schema + suffix

    @property
    def source_schema(self) -> str:
        return SOURCE_SCHEMA_PREFIX + self.schema

    @property
    def warehouse_schema(self) -> str:
        return spell_schema_name(self.target_schema)

    @property
    def staging_path(self) -> str:
        return STAGING_PATH.format(schema=self.target_schema, table=self.table)

    @property
    def sidecar_path(self) -> str:
        return SIDECAR_PATH.format(schema=self.target_schema, table=self.table)

    @property
    def rejects_path(self) -> str:
        return REJECTS_PATH.format(schema=self.target_schema, table=self.table)


def spec_from_config(schema: str, table: str, config: dict) -> TableSpec:
    """Build a spec from one parsed YAML table config."""
    object_id = config.get(CONFIG_OBJECT_ID)
    source = config.get(CONFIG_SOURCE) or ""
    return TableSpec(
        schema=schema,
        table=table,
        publish=bool(config.get(CONFIG_PUBLISH)),
        readers=tuple(config.get(CONFIG_READERS) or ()),
        keys=tuple(config.get(CONFIG_KEYS) or ()),
        environment=TEST if TEST_WORD.search(source) else PRODUCTION,
        object_id=None if object_id is None else int(object_id),
        target=config.get(CONFIG_TARGET),
    )


def load_specs(folder: str | Path) -> Iterator[TableSpec]:
    """Read every ``…/<schema>/<table>.yml`` below ``folder``, in path order."""
    import yaml

    for path in sorted(Path(folder).rglob("*.yml")):
        config = yaml.safe_load(path.read_text(encoding="utf-8")) or {}
        yield spec_from_config(path.parent.name, path.stem, config)
