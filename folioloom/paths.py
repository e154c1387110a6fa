"""Where the tables of one lake live."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LakePaths:
    base: str

    def _table(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    @property
    def documents(self) -> str:
        return self._table("parquet/documents")

    @property
    def chunks(self) -> str:
        return self._table("parquet/chunks")

    @property
    def embeddings(self) -> str:
        return self._table("parquet/embeddings")

    @property
    def blobs(self) -> str:
        return self._table("blobs")

    def vector_index(self, model: str) -> str:
        """Each model has an index of its own."""
        return self._table(f"vector_index/model={model}")

    @property
    def text_index(self) -> str:
        return self._table("text_index")

    @property
    def runs(self) -> str:
        return self._table("registry/runs")

    def rejects(self, table: str) -> str:
        """Rows that a job has kept out of a table."""
        return self._table(f"registry/rejects/{table}")

    @property
    def search_export(self) -> str:
        return self._table("search_export")
