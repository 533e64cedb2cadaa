"""A client of document servers. It stands beside the engine: queries read folders, and a mirror fills one."""

from __future__ import annotations

import base64
import json
import re
import time
import uuid
from collections.abc import Callable, MutableMapping
from dataclasses import dataclass, field
from typing import NamedTuple
from urllib.parse import urlencode

from ..access import acl_document, headers, members_document
from ..constants import CONTAINS, PREVIOUS, TURTLE
from ..settings import Settings
from .turtle import parse


class Response(NamedTuple):
    status: int
    headers: dict[str, str]
    body: str

    @property
    def ok(self) -> bool:
        return 200 <= self.status < 300

    @property
    def etag(self) -> str | None:
        return next((v for k, v in self.headers.items() if k.lower() == "etag" and v), None)


#: (method, address, headers, body) -> Response
Transport = Callable[[str, str, dict[str, str], str | None], Response]


def urllib_transport(method: str, url: str, head: dict[str, str], body: str | None) -> Response:
    """The transport of the standard library."""
    from urllib.error import HTTPError
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(url, body.encode() if body is not None else None, head, method=method), timeout=60) as r:
            return Response(r.status, dict(r.headers), r.read().decode())
    except HTTPError as e:
        return Response(e.code, dict(e.headers), e.read().decode(errors="replace"))


class Change(NamedTuple):
    changed: bool
    body: str | None
    etag: str | None


@dataclass
class Documents:
    """Reads and writes resources; token is sent with each request."""

    transport: Transport = urllib_transport
    token: str | None = None
    _made: set[str] = field(default_factory=set)

    def _send(self, method: str, url: str, body: str | None = None, **about) -> Response:
        return self.transport(method, url, headers(method, self.token, **about), body)

    def get(self, url: str, etag: str | None = None, accept: str = TURTLE) -> Response:
        return self._send("GET", url, etag=etag, accept=accept)

    def head(self, url: str) -> Response:
        return self._send("HEAD", url)

    def put(self, url: str, body: str, etag: str | None = None, container: bool = False) -> Response:
        return self._send("PUT", url, body, etag=etag, container=container)

    def post(self, url: str, body: str, slug: str | None = None) -> Response:
        return self._send("POST", url, body, slug=slug)

    def patch(self, url: str, body: str) -> Response:
        return self._send("PATCH", url, body)

    def delete(self, url: str) -> Response:
        return self._send("DELETE", url)

    def fetch(self, url: str) -> str | None:
        r = self.get(url)
        return r.body if r.ok else None

    def exists(self, url: str) -> bool:
        return self.head(url).ok

    def etag(self, url: str) -> str | None:
        r = self.head(url)
        return r.etag if r.ok else None

    def changed(self, url: str, etag: str) -> Change:
        """The body if it is another than that of the etag; no change if it is not, or if nothing could be read."""
        r = self.get(url, etag)
        return Change(True, r.body, r.etag) if r.ok else Change(False, None, etag if r.status == 304 else None)

    def listing(self, container: str) -> list[str]:
        """Members of a container as the listing names them; none if it cannot be read."""
        text = self.fetch(container)
        return [] if text is None else [t.object for t in parse(text, container) if t.predicate == CONTAINS]

    def ensure(self, container: str, title: str) -> bool:
        """Make a container unless it is there; asked once for each."""
        if container in self._made or self.exists(container):
            self._made.add(container)
            return True
        body = f'@prefix dcterms: <http://purl.org/dc/terms/> .\n\n<> dcterms:title "{title}" .\n'
        if ok := self.put(container, body, container=True).ok:
            self._made.add(container)
        return ok

    def set_acl(self, container: str, owner: str, members: str, mode: str) -> bool:
        return self.put(re.sub("/$", "", container) + "/.acl", acl_document(container, owner, members, mode)).ok

    def set_members(self, registry: str, members: list[str]) -> bool:
        return self.put(registry, members_document(members)).ok

    def add_member(self, registry: str, members: list[str], member: str) -> bool:
        return member in members or self.set_members(registry, [*members, member])

    def remove_member(self, registry: str, members: list[str], member: str) -> bool:
        return self.set_members(registry, [m for m in members if m != member])

    def mirror(self, container: str, write: Callable[[str, str], None], known: set[str]) -> int:
        """Hand the Turtle resources of a container that are not known to write(name, text); their number.

        A commit's parents are fetched too where they are not known, listed or not, and theirs, until no more are found.
        """
        todo, asked = list(self.listing(container)), set(known)
        n = 0
        while todo:
            member = todo.pop(0)
            name = member.rsplit("/", 1)[-1]
            if not name.endswith(".ttl") or name in asked:
                continue
            asked.add(name)
            if (text := self.fetch(member if "://" in member else container.rstrip("/") + "/" + name)) is not None:
                write(name, text)
                n += 1
                todo += [f"diff-{t.object}.ttl" for t in parse(text, member) if t.predicate == PREVIOUS]
        return n


def base64url(data: str | bytes) -> str:
    return base64.urlsafe_b64encode(data.encode() if isinstance(data, str) else data).rstrip(b"=").decode()


@dataclass
class Credentials:
    """Tokens, kept in a mapping from string to string."""

    settings: Settings
    kept: MutableMapping[str, str] = field(default_factory=dict)
    now: Callable[[], float] = time.time

    def token(self) -> str | None:
        """That of the settings if they have one, else the one stored last unless it has expired."""
        auth = self.settings.auth
        if auth.method == "bearer-token" and auth.bearerToken:
            return auth.bearerToken
        if (end := self.kept.get("expiry")) and self.now() >= float(end):
            return None
        return self.kept.get("token")

    @property
    def authenticated(self) -> bool:
        return self.token() is not None

    def store(self, token: str, seconds: float | None = None, refresh: str | None = None) -> None:
        self.kept["token"] = token
        if seconds:
            self.kept["expiry"] = str(self.now() + seconds)
        if refresh:
            self.kept["refresh"] = refresh

    def clear(self) -> None:
        self.kept.clear()

    def refresh(self, provider: str, transport: Transport = urllib_transport) -> bool:
        """Get a new token for the stored refresh token."""
        if not (old := self.kept.get("refresh")):
            return False
        auth = self.settings.auth
        body = urlencode({"grant_type": "refresh_token", "refresh_token": old, "client_id": auth.clientId, "client_secret": auth.clientSecret})
        r = transport("POST", f"{provider}/token", {"Content-Type": "application/x-www-form-urlencoded"}, body)
        if r.ok:
            got = json.loads(r.body)
            self.store(got["access_token"], got.get("expires_in"), got.get("refresh_token"))
        return r.ok

    def set_key(self, algorithm: str, key: dict, nonce: str | None = None) -> None:
        """The key that proofs of possession are signed with."""
        self.kept |= {"algorithm": algorithm, "key": json.dumps(key)} | ({"nonce": nonce} if nonce else {})

    def headers(self, method: str, url: str, sign: Callable[[str], str | bytes] | None = None) -> dict[str, str]:
        """Authorization, with a proof of possession if a key is set and sign is given."""
        if (token := self.token()) is None:
            return {}
        if sign is None or "key" not in self.kept or self.settings.auth.method != "solid-oidc":
            return {"Authorization": f"Bearer {token}"}
        proof = unsigned_proof(method, url, self.kept["algorithm"], json.loads(self.kept["key"]), self.kept.get("nonce"), self.now())
        return {"Authorization": f"DPoP {token}", "DPoP": f"{proof}.{base64url(sign(proof))}"}


def unsigned_proof(method: str, url: str, algorithm: str, key: dict, nonce: str | None, now: float) -> str:
    head = {"typ": "dpop+jwt", "alg": algorithm, "jwk": key}
    body = {"htm": method, "htu": re.split("[?#]", url)[0], "iat": int(now), "jti": str(uuid.uuid4())} | ({"nonce": nonce} if nonce else {})
    return ".".join(base64url(json.dumps(x, separators=(",", ":"))) for x in (head, body))
