"""A paged listing as a Python data source, one partition for each scope.

The fetcher is a function of (scope, page) that gives the records of a page, or a dict of
them (records) and of all there are (total); without a network it is a stub. Paging of a
scope stops after a page that brings no new key, or after ceil(total / page_size) pages.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class ListingSource(DataSource):
    """Options: fetch "module:function", scopes as JSON, keys as a CSV list, page_size.

    known is a Parquet folder on shared storage with the columns keys and scope (as JSON)
    of records that were listed before; a task reads those of its own scope.
    """

    @classmethod
    def name(cls) -> str:
        return "rollcall_listing"

    def schema(self) -> str:
        return self.options["record_schema"]

    def reader(self, schema) -> DataSourceReader:
        return ListingReader(dict(self.options), [f.name for f in schema.fields])


class ListingReader(DataSourceReader):
    def __init__(self, options: dict, columns: list[str]):
        self.options, self.columns = options, columns

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(json.dumps(s)) for s in json.loads(self.options["scopes"])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        module, _, function = self.options["fetch"].partition(":")
        fetch, scope = getattr(importlib.import_module(module), function), json.loads(partition.value)
        keys = self.options["keys"].split(",")
        seen = self._known(partition.value, keys)
        size, page = int(self.options.get("page_size", "0")), 1
        while got := fetch(scope, page):
            records, total = (got["records"], got.get("total")) if isinstance(got, dict) else (got, None)
            fresh = 0
            for r in records:
                key = tuple(r.get(k) for k in keys)
                if None in key:
                    continue  # no record without its key
                fresh += key not in seen
                seen.add(key)
                yield tuple(r.get(c) for c in self.columns)
            if not fresh or (total is not None and size and page >= -(-total // size)):
                return
            page += 1

    def _known(self, scope: str, keys: list[str]) -> set[tuple]:
        folder = self.options.get("known")
        if not folder:
            return set()
        import pyarrow.dataset as ds

        rows = ds.dataset(folder).to_table(columns=keys, filter=ds.field("scope") == scope)
        return set(zip(*(rows[k].to_pylist() for k in keys))) if len(rows) else set()
