"""Names, prefixes and addresses of resources, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import PREFIXES


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def compact_uri(uri, prefixes: dict[str, str] = PREFIXES) -> Column:
    """prefix:rest for the first prefix that fits, else the URI."""
    uri = _col(uri)
    out = uri
    for prefix, ns in reversed(prefixes.items()):
        out = F.when(F.startswith(uri, F.lit(ns)), F.concat(F.lit(prefix + ":"), uri.substr(F.lit(len(ns) + 1), F.length(uri)))).otherwise(out)
    return out


def expand_name(name, prefixes: dict[str, str] = PREFIXES) -> Column:
    """The URI of prefix:rest, or the name if its prefix is unknown."""
    name = _col(name)
    at = F.locate(":", name) if isinstance(name, str) else F.instr(name, ":")
    ns = F.create_map(*[F.lit(x) for kv in prefixes.items() if kv[1] for x in kv])[name.substr(F.lit(1), at - 1)] if prefixes else F.lit(None).cast("string")
    return F.when((at > 0) & ns.isNotNull(), F.concat(ns, name.substr(at + 1, F.length(name)))).otherwise(name)


def prefix_block(prefixes: dict[str, str] = PREFIXES) -> str:
    return "\n".join(f"@prefix {p}: <{ns}> ." for p, ns in prefixes.items())


def join_path(root, path) -> Column:
    """Root and path with one slash between, and one at the end."""
    inner = F.regexp_replace(_col(path), "^/+|/+$", "")
    base = F.regexp_replace(_col(root), "/+$", "")
    return F.when(inner == "", F.concat(base, F.lit("/"))).otherwise(F.concat(base, F.lit("/"), inner, F.lit("/")))


def below(root, path, rest: str) -> Column:
    """A fixed place below the joined path, such as diffs/ or meta.ttl."""
    return F.concat(join_path(root, path), F.lit(rest))


def links_container(root, path) -> Column:
    return below(root, path, "links/")


def diffs_container(root, path) -> Column:
    return below(root, path, "diffs/")


def views_container(root, path) -> Column:
    return below(root, path, "views/")


def meta_resource(root, path) -> Column:
    return below(root, path, "meta.ttl")


def members_resource(root, path) -> Column:
    return below(root, path, "members/index.ttl")


def resource(container, kind: str, name) -> Column:
    """The file of a link, diff or view in its container."""
    return F.concat(F.regexp_replace(_col(container), "/$", ""), F.lit(f"/{kind}-"), _col(name), F.lit(".ttl"))


def acl_resource(container) -> Column:
    return F.concat(F.regexp_replace(_col(container), "/$", ""), F.lit("/.acl"))


def name_of(url, kind: str) -> Column:
    """What the file of a link, diff or view is named by; null if it is none."""
    return F.nullif(F.regexp_extract(_col(url), kind + r"-([^/.]+)\.ttl$", 1), F.lit(""))


def contained(container, value) -> Column:
    """A member of a listing as a full address."""
    container, value = _col(container), _col(value)
    origin = F.regexp_extract(container, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    return (
        F.when(F.startswith(value, F.lit("http://")) | F.startswith(value, F.lit("https://")), value)
        .when(F.startswith(value, F.lit("/")), F.concat(origin, value))
        .otherwise(F.concat(F.regexp_replace(container, "/$", ""), F.lit("/"), value))
    )


def resource_base(address) -> Column:
    """The base of an instance that a resource holds: its address as it stands."""
    return address if isinstance(address, Column) else F.col(address)


def without_query(url) -> Column:
    return F.regexp_replace(_col(url), "[?#].*$", "")


def base64url(data) -> Column:
    """Base64 of the safe alphabet without padding."""
    return F.translate(F.replace(F.base64(_col(data)), F.lit("\r\n"), F.lit("")), "+/=", "-_")
