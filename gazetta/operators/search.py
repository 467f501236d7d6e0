"""Keyword search over divisions: pairing keywords with partitions, name filters, skipping what is done."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from gazetta.functions import scalar
from gazetta.operators.lineage import cut

#: Characters of keywords that one automaton holds; more keywords take more passes over the names.
AUTOMATON_CHARS = 4_000_000
#: Hits that a task holds before it hands them on.
HITS = 50_000


def in_provinces(divisions: DataFrame, codes: Sequence[str] | None, column: str = "code") -> DataFrame:
    return divisions.where(F.col(column).isin(*codes)) if codes else divisions


def keyword_partitions(keywords: Sequence[str], divisions: DataFrame) -> DataFrame:
    """Every keyword with every initial division: an array of the (few, ordered) keywords exploded on each division row."""
    chars = F.array(*[F.lit(k) for k in keywords]) if keywords else F.array().cast("array<string>")
    return divisions.select(F.explode(chars).alias("keyword"), F.col("code"))


def search(names: DataFrame, keywords: Sequence[str], mode: str = "contain", column: str = "name") -> DataFrame:
    """Rows of names for each keyword that they contain or equal: the scan filters, then the keyword array explodes."""
    chars = F.array(*[F.lit(k) for k in keywords]) if keywords else F.array().cast("array<string>")
    hits = F.filter(chars, lambda k: F.coalesce(scalar.name_matches(F.col(column), k, mode), F.lit(False)))
    return names.select("*", F.explode(hits).alias("keyword"))


def _portions(keywords: DataFrame, most: int) -> Iterator[list[str]]:
    """The keywords in portions of at most `most` characters (one keyword at least), one on the driver at a time."""
    part, size = [], 0
    for (keyword,) in keywords.toLocalIterator():
        if part and size + len(keyword) > most:
            yield part
            part, size = [], 0
        part.append(keyword)
        size += len(keyword)
    if part:
        yield part


def _by_automaton(names: DataFrame, keywords: list[str], column: str, keep: Sequence[str]) -> DataFrame:
    """The kept columns of names for each keyword they contain: one walk over each text finds all keywords, its set of characters those of one character."""
    schema = StructType([*names.select(*keep).schema.fields, StructField("keyword", StringType())])
    arrow, n = to_arrow_schema(schema), len(keep)
    shipped = names.sparkSession.sparkContext.broadcast(keywords)  # AUTOMATON_CHARS at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        single = {keyword: k for k, keyword in enumerate(shipped.value) if len(keyword) == 1}
        for k, keyword in enumerate(shipped.value):
            if len(keyword) > 1:
                automaton.add_word(keyword, k)
        automaton.make_automaton()
        words = pa.array(shipped.value, pa.string())
        for batch in batches:
            rows: list[int] = []
            found: list[int] = []
            for i, value in enumerate(batch.column(n)):
                text = value.as_py() or ""
                hits = {k for _, k in automaton.iter(text)} if len(automaton) else set()
                hits.update(single[c] for c in single.keys() & set(text))
                rows += [i] * len(hits)
                found += hits
                if len(rows) >= HITS or i == batch.num_rows - 1:
                    at = pa.array(rows, pa.int64())
                    yield pa.RecordBatch.from_arrays([*(c.take(at) for c in batch.columns[:n]), words.take(pa.array(found, pa.int64()))], schema=arrow)
                    rows, found = [], []

    return names.select(*keep, F.col(column).alias("_text")).mapInArrow(run, schema)


def search_many(names: DataFrame, keywords: DataFrame, mode: str = "contain", column: str = "name", most: int = AUTOMATON_CHARS, keep: Sequence[str] | None = None) -> DataFrame:
    """As `search`, for a table `keywords` (keyword) of any size: rows of names with each keyword that they contain or equal.

    Exact names are a join. For parts of names, keywords make an Aho-Corasick automaton, one for each `most` characters
    of keywords; those of one character are looked up in the set of a name's characters. Repeated keywords count once,
    null ones never, the empty one is in every name that is not null; a null name matches nothing. `keep` names the
    columns of names to return (all by default): leave long texts out, since each hit has a copy of what is kept.
    """
    keep = names.columns if keep is None else list(keep)
    known = cut(keywords.select("keyword").where("keyword is not null").distinct())
    if mode == "exact":
        return names.join(known, F.col(column) == F.col("keyword")).select(*keep, "keyword")
    if mode != "contain":
        raise ValueError(f"unknown match mode: {mode}")
    parts = [_by_automaton(names, portion, column, keep) for portion in _portions(known.where("keyword <> ''"), most)]
    empty = not known.where("keyword = ''").isEmpty()
    if empty or not parts:
        parts.append(names.where(F.col(column).isNotNull() & F.lit(empty)).select(*keep, F.lit("").alias("keyword")))
    return reduce(DataFrame.unionByName, parts)


def not_completed(partitions: DataFrame, progress: DataFrame) -> DataFrame:
    return partitions.join(progress.select("keyword", "code"), ["keyword", "code"], "left_anti")
