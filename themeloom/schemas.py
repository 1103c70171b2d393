"""Schemas of the entities."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _I = T.StringType(), T.LongType(), T.IntegerType()


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


REVIEWS = _struct(("app", _S), ("name", _S), ("rating", _S), ("review", _S))
REVIEW_COLUMNS = ("name", "rating", "review")
SAMPLING_LOG = _struct(("app", _S), ("name", _S), ("global_seq", _L), ("batch_id", _L), ("run_id", _S))
CODINGS = _struct(
    ("app", _S), ("batch_id", _L), ("theme", _S), ("code", _S), ("quote", _S), ("src_file", _S), ("line_no", _I)
)
CODEBOOK = _struct(
    ("app", _S), ("version", _S), ("theme", _S), ("code", _S), ("definition", _S),
    ("include", T.ArrayType(_S)), ("exclude", T.ArrayType(_S)), ("samples", T.ArrayType(_S)),
    ("related", T.ArrayType(_struct(("code", _S), ("diff", _S)))),
)
DECISIONS = _struct(
    ("app", _S), ("batch_id", _L), ("seq", _I), ("type", _S), ("source_codes", T.ArrayType(_S)),
    ("target_codes", T.ArrayType(_S)), ("reason", _S), ("rule", _S),
)
CHANGE = _struct(
    ("type", _S), ("themes", T.ArrayType(_S)), ("codes_count", _I), ("reason", _S), ("code", _S), ("theme", _S),
    ("source_codes", T.ArrayType(_S)), ("target_code", _S),
)
CHANGE_LOG = _struct(
    ("batch_id", _I), ("timestamp", _S), ("changes", T.ArrayType(CHANGE)), ("codebook_version", _S),
    ("themes", T.ArrayType(_S)),
)
LAYERS = _struct(("app", _S), ("stage", _S), ("layer", _I), ("content", _S))
DICTIONARY = _struct(("app", _S), ("code", _S), ("term", _S))
