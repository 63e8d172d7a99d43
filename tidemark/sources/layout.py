"""M5, M6: where tables and checkpoints live."""

from __future__ import annotations

from typing import NamedTuple
from urllib.parse import urlparse

# Storage kind by URI scheme, and the tiers.
STORAGE = {"abfss": "blob", "abfs": "blob", "s3": "s3", "s3a": "s3"}
TIERS = ("bronze", "silver", "gold")


def storage_kind(uri: str) -> str | None:
    """M6: ``blob``, ``s3``, or None for any other scheme."""
    return STORAGE.get(urlparse(uri).scheme.lower())


class TableName(NamedTuple):
    """``{db}_{table}``, split at the first underscore only."""

    tier: str
    db: str | None
    table: str

    @classmethod
    def parse(cls, tier: str, folder: str) -> TableName:
        db, found, table = folder.partition("_")
        return cls(tier, db, table) if found else cls(tier, None, folder)

    @property
    def folder(self) -> str:
        return f"{self.db}_{self.table}" if self.db else self.table

    @property
    def view(self) -> str:
        return f"{self.tier}_{self.table}"


class Lake(NamedTuple):
    """M5: a lakehouse root, e.g. ``s3a://bucket/lakehouse``."""

    root: str

    @classmethod
    def at(cls, storage: str, bucket: str, base_dir: str = "lakehouse") -> Lake:
        return cls(f"{storage}://{bucket}/{base_dir}")

    def path(self, tier: str, table: str, db: str | None = None) -> str:
        return f"{self.root}/{tier}/{TableName(tier, db, table).folder}"

    def checkpoint(self, tier: str, table: str, db: str | None = None, reader: str = "stream") -> str:
        """Outside every table directory, one per reader."""
        return f"{self.root}/_checkpoints/{tier}/{TableName(tier, db, table).folder}/{reader}"


def split_topic(topic: str) -> tuple[str, str, str]:
    """``prefix.db.collection`` to ``(prefix.db, db, collection)``."""
    *head, name = topic.split(".")
    return ".".join(head), head[-1], name
