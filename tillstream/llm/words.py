"""Words as bytes between ASCII white space, and rows in and out of Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of `[^\\x20\\x09-\\x0D]` in UTF-8 (what `bytes.split` cuts at), A-Z lower-cased on demand; null has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    return (data.translate(_LOWER) if lower else data).split()


def words_of_all(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of `words_of` for a whole array: all of them in order, and the number of each text's."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten().cast(pa.binary())
    full = pc.not_equal(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty word
    owners = pc.list_parent_indices(lists).filter(full).to_numpy()
    return words.filter(full), np.bincount(owners, minlength=len(texts))


def map_rows(df: DataFrame, make: Callable[[], Callable[[tuple], tuple]], schema: pa.Schema, ddl: str) -> DataFrame:
    """A row for each row, through Arrow. `make` is called once in each task and returns the row function.

    Cells are taken out of a batch one at a time, so that a batch of long texts is held once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = make()
        for batch in batches:
            if batch.num_rows:
                rows = [row(tuple(x.as_py() for x in cells)) for cells in zip(*batch.columns)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema
                )

    return df.mapInArrow(run, ddl)
