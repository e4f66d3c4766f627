"""Numbered manifests: the versions of a table, each a small file that is created once.

A version becomes visible when its manifest exists; whoever creates number n + 1 first
wins, and everyone else has to read the new state and try again. The newest manifest is
never touched, so readers always find one.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from tidemark.sources import files


@dataclass
class Manifests:
    spark: SparkSession
    root: str

    @property
    def folder(self) -> str:
        return f"{self.root}/manifests"

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in files.names(self.spark, self.folder)
                      if n.endswith(".json") and not n.startswith("."))

    def latest(self) -> dict | None:
        """The current version; None where nothing was ever written."""
        found = self.numbers()
        if found:
            return files.read_json(self.spark, self._path(found[-1]))
        if [n for n in files.names(self.spark, self.root) if n != "manifests"]:
            raise FileNotFoundError(f"{self.root} holds files but no manifest")
        return None

    def add(self, content: dict) -> dict | None:
        """Make ``content`` the version after ``content['number'] - 1``; None if that is taken."""
        content = {**content, "at": datetime.now(timezone.utc).isoformat()}
        return content if files.create_json(self.spark, self._path(content["number"]), content) else None

    def expire(self, retain_s: int) -> None:
        """Forget versions that were replaced longer ago; the current one stays."""
        found = self.numbers()
        for number, after in zip(found, found[1:]):
            replaced = files.read_json(self.spark, self._path(after))
            if replaced is None or _age(replaced["at"]) <= timedelta(seconds=retain_s):
                break
            files.remove(self.spark, self._path(number))


def _age(at: str) -> timedelta:
    return datetime.now(timezone.utc) - datetime.fromisoformat(at)


def split_by_age(retired: list[dict], retain_s: int) -> tuple[list[dict], list[dict]]:
    """Replaced folders whose readers have had their time, and the others."""
    old = [r for r in retired if _age(r["at"]) > timedelta(seconds=retain_s)]
    return old, [r for r in retired if r not in old]
