"""Settings of an engine, from JSON; what is missing or of the wrong kind has its default."""

from __future__ import annotations

import dataclasses
import json
from dataclasses import dataclass, field
from typing import Any

# What settings may say.
SYNC_MODES = ("bidirectional", "publish-only", "subscribe-only")
MEMBERSHIP = ("open", "members-only", "private")
STRATEGIES = ("raw-triples", "reified", "named-graphs")
FORMATS = ("text/turtle", "application/ld+json", "application/n-triples")
METHODS = ("solid-oidc", "bearer-token")


def _one_of(*names: str):
    return lambda x: x in names if isinstance(x, str) else False


def _is(kind: type):
    return lambda x: isinstance(x, kind)


def _positive(x: Any) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool) and x > 0


def _setting(default: Any, check):
    if isinstance(default, list):
        return field(default_factory=lambda: list(default), metadata={"check": check})
    return field(default=default, metadata={"check": check})


@dataclass
class Rendering:
    strategy: str = _setting("reified", _one_of(*STRATEGIES))
    format: str = _setting("text/turtle", _one_of(*FORMATS))
    includeProvenance: bool = _setting(True, _is(bool))


@dataclass
class Sync:
    notificationsEnabled: bool = _setting(True, _is(bool))
    pollIntervalMs: float = _setting(30000, _positive)
    useEtags: bool = _setting(True, _is(bool))


@dataclass
class Auth:
    method: str = _setting("bearer-token", _one_of(*METHODS))
    bearerToken: str = _setting("", _is(str))
    clientId: str = _setting("", _is(str))
    clientSecret: str = _setting("", _is(str))


@dataclass
class Batching:
    windowMs: float = _setting(60000, _positive)
    maxLinksPerResource: float = _setting(100, _positive)


@dataclass
class DualLanguage:
    enabled: bool = _setting(False, _is(bool))
    excludePredicates: list = _setting([], _is(list))


@dataclass
class Settings:
    syncMode: str = _setting("bidirectional", _one_of(*SYNC_MODES))
    rendering: Rendering = field(default_factory=Rendering)
    sync: Sync = field(default_factory=Sync)
    auth: Auth = field(default_factory=Auth)
    batching: Batching = field(default_factory=Batching)
    membership: str = _setting("members-only", _one_of(*MEMBERSHIP))
    dualLanguage: DualLanguage = field(default_factory=DualLanguage)

    @property
    def publishes(self) -> bool:
        return self.syncMode != "subscribe-only"

    @property
    def subscribes(self) -> bool:
        return self.syncMode != "publish-only"


def _filled(kind: type, given: Any):
    out = kind()
    for f in dataclasses.fields(kind):
        value = given.get(f.name) if isinstance(given, dict) else None
        if "check" not in f.metadata:
            setattr(out, f.name, _filled(type(getattr(out, f.name)), value))
        elif f.metadata["check"](value):
            setattr(out, f.name, value)
    return out


def parse_settings(raw: str | None) -> Settings:
    try:
        return _filled(Settings, json.loads(raw) if raw else None)
    except ValueError:
        return Settings()
