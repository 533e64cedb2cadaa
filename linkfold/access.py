"""Access control documents and request headers, as text. Their strings are fixed values of the formats."""

from __future__ import annotations

from .constants import N3, PREFIXES, TURTLE, term


def _rule(name: str, who: str, container: str, modes: str) -> str:
    lines = [f"<#{name}> a acl:Authorization", f"    {who}", f"    acl:accessTo <{container}>", f"    acl:default <{container}>", f"    acl:mode {modes}"]
    return " ;\n".join(lines) + " ."


def acl_document(container: str, owner: str, members: str, mode: str) -> str:
    """Who may do what in a container. mode: open, members-only or private."""
    read, write = "acl:Read", "acl:Read, acl:Write"
    group, everyone = f"acl:agentGroup <{members}#group>", "acl:agentClass foaf:Agent"
    rules = [_rule("owner", f"acl:agent <{owner}>", container, "acl:Read, acl:Write, acl:Control")]
    if mode == "open":
        rules.append(_rule("public", everyone, container, write))
    if mode == "members-only":
        rules.append(_rule("members", group, container, write))
        rules.append(_rule("public", everyone, container, read))
    if mode == "private":
        rules.append(_rule("members", group, container, write))
    head = "\n".join(f"@prefix {p}: <{PREFIXES[p]}> ." for p in ("acl", "foaf"))
    out = "\n\n".join([head, *rules])
    return out if mode in ("open", "members-only", "private") else out + "\n"


def members_document(members: list[str]) -> str:
    """The registry of a container's members."""
    head = f"@prefix vcard: <{PREFIXES['vcard']}> .\n\n"
    return head + " ;\n    ".join(["<#group> a vcard:Group", *[f"vcard:hasMember <{m}>" for m in members]]) + " ."


def headers(method: str, token: str | None = None, etag: str | None = None, slug: str | None = None, container: bool = False, accept: str | None = None) -> dict[str, str]:
    """Headers of a request to a document server."""
    out: dict[str, str] = {}
    if method == "GET":
        out["Accept"] = accept or TURTLE
    if method in ("PUT", "POST"):
        out["Content-Type"] = TURTLE
    if method == "PATCH":
        out["Content-Type"] = N3
    if method == "POST" and slug:
        out["Slug"] = slug
    if container:
        out["Link"] = f'<{term("ldp", "BasicContainer")}>; rel="type"'
    if etag:
        out["If-None-Match" if method in ("GET", "HEAD") else "If-Match"] = etag
    if token:
        out["Authorization"] = f"Bearer {token}"
    return out
