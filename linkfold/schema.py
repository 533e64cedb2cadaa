"""Schemas of the engine's tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def columns(**kinds) -> T.StructType:
    """A struct of named columns; kinds are names of simple types, or types."""
    return T.StructType([T.StructField(name, _KINDS[kind] if isinstance(kind, str) else kind) for name, kind in kinds.items()])


def none(spark: SparkSession, kind: T.StructType | str) -> DataFrame:
    """No rows. The optimizer knows that there are none, and leaves out joins and unions with them."""
    kind = T.StructType.fromDDL(kind) if isinstance(kind, str) else kind
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in kind]).filter(F.lit(False))


PROOF = columns(signature="string", key="string")
LINK = columns(source="string", predicate="string", target="string", author="string", timestamp="string", proof=PROOF, status="string")
LINKS = columns(link_hash="string", **{f.name: f.dataType for f in LINK})
TOMBSTONE = columns(link_hash="string", link=LINK)
COMMITS = columns(commit_hash="string", author="string", timestamp="string", previous=T.ArrayType(T.StringType()), additions=T.ArrayType(LINK), removals=T.ArrayType(TOMBSTONE), ord="long")
TRIPLES = columns(doc="string", ord="int", subject="string", predicate="string", object="string", object_is_literal="boolean", object_datatype="string")
INSTANCES = columns(base="string", author="string", timestamp="string", properties=T.MapType(T.StringType(), T.StringType()))
#: A scalar that is a string, a number or a boolean; null stands for no value.
EVAL = columns(kind="string", s="string", n="double", b="boolean")
PEERS = columns(did="string", metadata="string", is_local="boolean")
VALUES = columns(key="string", value="string", at="long")
VERSIONS = columns(version="string", at="long")
