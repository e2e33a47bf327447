"""Reading one nested JSON document by several tasks (A3).

``AnswersDocument`` is a Python data source.  A file is cut into byte ranges; a
task reads the elements that begin in its range.  Where an element begins can be
told anywhere in the file: a brace, then one of the element's field names in
plain quotes and a colon.  Inside a JSON string a quote is escaped, or ends the
string and is not followed by a name, so no text looks like that.  Elements must
not hold objects that begin with one of these names themselves.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from urllib.parse import unquote, urlparse

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from chatframe.schemas import ANSWER

SPLIT_BYTES = 16 << 20
LOOK = 1 << 16      # read beyond a range: white space that the beginning of an element may have
ELEMENT = 1 << 14   # bytes of an element decoded at first


class ByteRange(InputPartition):
    def __init__(self, start: int, end: int):
        super().__init__((start, end))
        self.start, self.end = start, end


def local_path(path: str) -> str | None:
    """The mounted path that tasks can open, or None (another file system)."""
    uri = urlparse(path)
    return unquote(uri.path) if uri.scheme in ("", "file") else None


class ElementReader(DataSourceReader):
    """Elements of the array ``name`` of a document, by byte ranges."""

    def __init__(self, path: str, schema: StructType, split: int):
        self.path, self.names, self.split = path, schema.fieldNames(), split

    def partitions(self) -> list[ByteRange]:
        size = os.path.getsize(self.path)
        return [ByteRange(s, min(size, s + self.split)) for s in range(0, max(1, size), self.split)]

    def read(self, partition: ByteRange) -> Iterator[tuple]:
        names = "|".join(re.escape(json.dumps(n)) for n in self.names)
        begins = re.compile(rf"\{{\s*(?:{names})\s*:".encode())
        decode = json.JSONDecoder().raw_decode
        with open(self.path, "rb") as f:
            f.seek(partition.start)
            size = partition.end - partition.start
            data, at = f.read(size + LOOK), 0
            while (m := begins.search(data, at)) is not None and m.start() < size:
                start, take = m.start(), ELEMENT
                while True:
                    text = data[start:start + take].decode("utf-8", "ignore")
                    try:
                        row, length = decode(text)
                        break
                    except json.JSONDecodeError:  # cut off, unless the file ends here
                        if start + take >= len(data):
                            block = f.read(max(take, LOOK))
                            if not block:
                                raise
                            data += block
                        take *= 2
                at = start + len(text[:length].encode())
                yield tuple(None if (v := row.get(n)) is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)
                            for n in self.names)


class AnswersDocument(DataSource):
    """``spark.read.format("answers_document").load(path)``: the elements of a
    nested answers file, all fields as strings; option ``split``: bytes a task."""

    @classmethod
    def name(cls) -> str:
        return "answers_document"

    def schema(self) -> StructType:
        return ANSWER

    def reader(self, schema: StructType) -> ElementReader:
        path = local_path(self.options["path"])
        if path is None:
            raise ValueError("tasks can't open this file system; read_answers does")
        return ElementReader(path, schema, int(self.options.get("split", SPLIT_BYTES)))
