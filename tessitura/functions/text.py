"""Text normalisation and edit distances as column expressions, paths and URIs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessitura.functions import edits
from tessitura.functions.music import col

_SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"


def normalise(text) -> Column:
    """STR7: lower case, without punctuation, white space collapsed and trimmed; letters of all scripts stay."""
    bare = F.regexp_replace(F.lower(col(text)), r"[^\p{L}\p{N}_\s\x1c-\x1f\x85\p{Z}]", "")
    return F.trim(F.regexp_replace(bare, _SPACES, " "))


def tokens(text) -> Column:
    """Words of a normalised text; none for the empty one."""
    return F.filter(F.split(col(text), " "), lambda w: w != "")


def align(a: list[str], b: list[str]) -> tuple[int, int, int, int]:
    """Hits, substitutions, deletions, insertions of one best alignment; ties prefer the diagonal, then deletion."""
    known: dict[str, int] = {}
    return edits.align(*(np.array([known.setdefault(w, len(known)) for w in words], np.int64) for words in (a, b)))


def _numbered(*lists: pa.Array) -> list[edits.Side]:
    """Equal words of a batch get equal numbers."""
    flat = [x.flatten() for x in lists]
    numbers = pc.fill_null(pa.concat_arrays(flat).dictionary_encode().indices, -3).to_numpy(zero_copy_only=False)
    ends = np.cumsum([len(x) for x in flat])
    return [(numbers[e - len(x) : e], pc.fill_null(pc.list_value_length(whole), 0).to_numpy(zero_copy_only=False).astype(np.int64)) for x, e, whole in zip(flat, ends, lists, strict=True)]


_COUNTS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("hits", "substitutions", "deletions", "insertions")])


def _spelled(*texts: pa.Array) -> list[edits.Side]:
    return [(np.frombuffer("".join(t for t in x.to_pylist() if t is not None).encode("utf-32-le"), np.uint32), pc.fill_null(pc.utf8_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64)) for x in texts]


def _distances(sides, size, a: pa.Array, b: pa.Array) -> pa.Array:
    """For some of the batch at a time, as numbers take more memory than texts."""
    parts = (pc.fill_null(size(a), 0).to_numpy(zero_copy_only=False).astype(np.int64) + pc.fill_null(size(b), 0).to_numpy(zero_copy_only=False)).cumsum() >> 22
    bounds = [0, *(np.flatnonzero(np.diff(parts)) + 1).tolist(), len(a)]
    found = [edits.distances(*sides(a[i:j], b[i:j])) for i, j in zip(bounds, bounds[1:], strict=False)]
    return pa.array(np.concatenate(found), pa.int32(), mask=pc.or_(a.is_null(), b.is_null()).to_numpy(zero_copy_only=False))


@F.arrow_udf(T.IntegerType())
def word_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Edits between two arrays of words, of any number of distinct ones; null if one is."""
    return _distances(_numbered, pc.list_value_length, a, b)


@F.arrow_udf(T.IntegerType())
def char_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """What ``levenshtein`` gives, for 64 places at a time."""
    return _distances(_spelled, pc.utf8_length, a, b)


@F.arrow_udf(_COUNTS)
def alignment(a: pa.Array, b: pa.Array) -> pa.Array:
    """TXT3: the counts need a backtrace, so this one is Arrow-batched Python, a batch of pairs at a time."""
    found = edits.alignments(*_numbered(a, b))
    return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in found.T], _COUNTS.names, mask=pc.or_(a.is_null(), b.is_null()))


def join_segments(texts) -> Column:
    """STR8."""
    return F.array_join(F.transform(col(texts), lambda t: F.trim(t)), " ")


def path_key(path) -> Column:
    """STR1: ten hexadecimal digits of the path's md5."""
    return F.substring(F.md5(col(path)), 1, 10)


def output_stem(source, model) -> Column:
    """STR4."""
    return F.concat(F.lit("source_"), col(source), F.lit("_rvcmodel_"), F.coalesce(col(model), F.lit("norvc")))


def bucket_of(uri) -> Column:
    """STR5: the authority of ``scheme://bucket/prefix``; null if it isn't one."""
    return F.nullif(F.regexp_extract(col(uri), r"^[a-z0-9+.-]+://([^/]+)", 1), F.lit(""))


def prefix_of(uri, trailing: bool = True) -> Column:
    """STR5: the path, with one trailing slash or none; an empty prefix stays empty."""
    bare = F.regexp_replace(F.regexp_extract(col(uri), r"^[a-z0-9+.-]+://[^/]+/?(.*)$", 1), "/+$", "")
    return F.when(bare == "", bare).otherwise(F.concat(bare, F.lit("/"))) if trailing else bare


def last_segment(path) -> Column:
    """STR6."""
    return F.element_at(F.split(F.regexp_replace(col(path), "/+$", ""), "/"), -1)
