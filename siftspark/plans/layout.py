"""Where the tables of one archive lie."""

from __future__ import annotations

from dataclasses import dataclass

from siftspark.sinks.buckets import BUCKETS


@dataclass(frozen=True)
class Layout:
    """One root for all tables. `buckets` is fixed when a table is first written: choose it
    so that a bucket of the largest table is a few GB."""

    root: str
    buckets: int = BUCKETS

    def raw(self, run: str | None = None) -> str:
        return f"{self.root}/raw" + (f"/run={run}" if run else "")

    def versions(self, run: str | None = None) -> str:
        return f"{self.root}/versions" + (f"/run={run}" if run else "")

    def landing(self, run: str | None = None) -> str:
        """Category documents stay per run, so those of older runs can be read again."""
        return f"{self.root}/landing" + (f"/run={run}" if run else "")

    def arrivals(self, batch: int) -> str:
        return f"{self.root}/arrivals/batch={batch}"

    @property
    def ledger(self) -> str:
        return f"{self.root}/ledger"

    @property
    def scope(self) -> str:
        return f"{self.root}/current_run_categories"

    def bronze(self, category: str) -> str:
        return f"{self.root}/bronze/{category}"

    def quarantine(self, run: str | None = None, step: str | None = None) -> str:
        """What a run, or a batch of a stream, set aside in one of its steps."""
        return f"{self.root}/quarantine" + (f"/run={run}/step={step}" if run else "")

    def silver(self, category: str) -> str:
        return f"{self.root}/silver/{category}"

    def rejected(self, category: str) -> str:
        return f"{self.root}/rejected/{category}"
