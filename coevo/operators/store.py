"""A job store with atomic claims, in a local SQL database that the driver owns.

Parquet tables have no row updates; where several drivers claim work from one list, each claim must be one transaction.
The store holds job rows only (an id, a state, an owner), never data; ``frame`` gives them to Spark.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

KINDS = {
    "alignments": "pid TEXT UNIQUE NOT NULL, length INTEGER, align_nseqs INTEGER, filtered_nseqs INTEGER",
    "couplings": "name TEXT UNIQUE NOT NULL, pid1 TEXT, pid2 TEXT, length INTEGER, number INTEGER, effnumber INTEGER",
}


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class JobStore:
    """One table of jobs of a kind; its columns are made where they are missing, so an older table grows into a new one."""

    def __init__(self, path: str, table: str, kind: str):
        self.db = sqlite3.connect(path, timeout=60, isolation_level=None)
        self.table, self.key = _name(table), KINDS[kind].split()[0]
        state = "status INTEGER, job_id TEXT, claimed_at REAL"
        self.db.execute(f"CREATE TABLE IF NOT EXISTS {self.table} (id INTEGER PRIMARY KEY, {KINDS[kind]}, {state})")
        for column in f"{KINDS[kind]}, {state}".split(", "):
            self.add_column(*column.split()[:2])
        self.db.execute(f"CREATE INDEX IF NOT EXISTS {_name(table + '_status')} ON {self.table} (status)")

    def add_column(self, name: str, kind: str) -> None:
        have = {row[1] for row in self.db.execute(f"PRAGMA table_info({self.table})")}
        if name not in have:
            self.db.execute(f"ALTER TABLE {self.table} ADD COLUMN {_name(name)} {kind}")

    def insert(self, keys: Iterable[str], status: int | None = -1) -> int:
        """Insert the keys that are not there yet; returns how many were."""
        before = self.db.total_changes
        self._many(f"INSERT OR IGNORE INTO {self.table} ({self.key}, status) VALUES (?, ?)", [(k, status) for k in keys])
        return self.db.total_changes - before

    def _many(self, sql: str, rows: list[tuple]) -> None:
        self.db.execute("BEGIN IMMEDIATE")
        try:
            self.db.executemany(sql, rows)
            self.db.execute("COMMIT")
        except BaseException:
            self.db.execute("ROLLBACK")
            raise

    def claim(self, n: int, owner: str, at: float, null_too: bool = False) -> list[tuple[int, str, int]]:
        """(id, key, state) of up to n rows that nobody else gets: the first free ones by id, as one statement under a write lock."""
        free = "status IN (-1, 2)" + (" OR status IS NULL" if null_too else "")
        self.db.execute("BEGIN IMMEDIATE")
        rows = self.db.execute(
            f"UPDATE {self.table} SET status = CASE status WHEN 2 THEN 3 ELSE 1 END, job_id = ?, claimed_at = ? "
            f"WHERE id IN (SELECT id FROM {self.table} WHERE ({free}) AND claimed_at IS NULL ORDER BY id LIMIT ?) RETURNING id, {self.key}, status",
            (owner, at, n)).fetchall()
        self.db.execute("COMMIT")
        return sorted(rows)

    def finish(self, results: list[tuple[int, bool]]) -> None:
        """Outcomes (id, ended well) in one transaction: done, or one attempt less."""
        self._many(f"UPDATE {self.table} SET status = CASE WHEN ? THEN 0 ELSE min(status + 1, 4) END, job_id = NULL, claimed_at = NULL WHERE id = ? AND status IN (1, 3)", [(good, i) for i, good in results])

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = self.db.execute(f"SELECT id, {self.key}, length, status, job_id, claimed_at FROM {self.table} ORDER BY id").fetchall()
        return spark.createDataFrame(rows, f"id long, {self.key} string, length int, status int, job_id string, claimed_at double")
