import base64
import json

from linkfold.constants import PREVIOUS
from linkfold.settings import Settings
from linkfold.sources.http import Credentials, Documents, Response, base64url


class Server:
    """Documents in a dict."""

    def __init__(self):
        self.held, self.asked = {}, []

    def __call__(self, method, url, head, body):
        self.asked.append((method, url, head))
        if method == "PUT":
            self.held[url] = body
            return Response(201, {}, "")
        if url not in self.held:
            return Response(404, {}, "")
        if method == "GET" and head.get("If-None-Match") == "e1":
            return Response(304, {}, "")
        return Response(200, {"ETag": "e1"}, self.held[url])


def test_documents():
    server = Server()
    d = Documents(server, "tok")
    assert d.fetch("http://p/x") is None and not d.exists("http://p/x") and d.etag("http://p/x") is None
    assert d.put("http://p/x", "body", etag="e0").ok and server.asked[-1][2] == {"Content-Type": "text/turtle", "If-Match": "e0", "Authorization": "Bearer tok"}
    assert d.etag("http://p/x") == "e1" and d.changed("http://p/x", "e0") == (True, "body", "e1")
    assert d.changed("http://p/x", "e1") == (False, None, "e1") and d.changed("http://p/none", "e1") == (False, None, None)
    assert d.ensure("http://p/diffs/", "Diffs") and "Link" in server.asked[-1][2]
    before = len(server.asked)
    assert d.ensure("http://p/diffs/", "Diffs") and len(server.asked) == before


def test_mirror():
    server, got = Server(), {}
    server.held = {"http://p/d/": "<> ldp:contains <diff-a.ttl>, <http://p/d/diff-b.ttl>, <note.txt> .", "http://p/d/diff-a.ttl": "A", "http://p/d/diff-b.ttl": "B"}
    assert Documents(server).mirror("http://p/d/", got.__setitem__, {"diff-b.ttl"}) == 1 and got == {"diff-a.ttl": "A"}
    assert Documents(server).listing("http://p/none/") == []


def test_mirror_fetches_parents_that_are_not_listed():
    server, got = Server(), {}
    commit = f"<> <{PREVIOUS}> {{}} ."
    server.held = {"http://p/d/": "<> ldp:contains <diff-c3.ttl> .", "http://p/d/diff-c3.ttl": commit.format('"c2", "c0"'), "http://p/d/diff-c2.ttl": commit.format('"c1"'), "http://p/d/diff-c1.ttl": commit.format('"gone"'), "http://p/d/diff-c0.ttl": "known"}
    assert Documents(server).mirror("http://p/d/", got.__setitem__, {"diff-c0.ttl"}) == 3
    assert sorted(got) == ["diff-c1.ttl", "diff-c2.ttl", "diff-c3.ttl"]


def test_members_and_acl():
    server = Server()
    d = Documents(server)
    assert d.set_acl("http://p/c/", "http://me", "http://p/m", "open") and "http://p/c/.acl" in server.held
    assert d.add_member("http://p/m", ["a"], "a") and "http://p/m" not in server.held
    assert d.add_member("http://p/m", ["a"], "b") and "<b>" in server.held["http://p/m"]
    assert d.remove_member("http://p/m", ["a", "b"], "b") and "<b>" not in server.held["http://p/m"]


def test_credentials():
    clock = [100.0]
    c = Credentials(Settings(), now=lambda: clock[0])
    assert not c.authenticated and c.headers("GET", "u") == {}
    c.store("t", 10, "r")
    assert c.token() == "t"
    clock[0] = 110
    assert c.token() is None
    assert c.refresh("http://idp", lambda m, u, h, b: Response(200, {}, json.dumps({"access_token": "n", "expires_in": 5}))) and c.token() == "n"
    c.settings.auth.method = "solid-oidc"
    c.set_key("ES256", {"kty": "EC"}, "once")
    head = c.headers("GET", "http://h/p?q#f", sign=lambda text: "sig")
    proof = json.loads(base64.urlsafe_b64decode(head["DPoP"].split(".")[1] + "==="))
    assert head["Authorization"] == "DPoP n" and (proof["htu"], proof["nonce"], proof["iat"]) == ("http://h/p", "once", 110)
    c.clear()
    assert not c.authenticated and not c.refresh("http://idp")
    c.settings.auth.method, c.settings.auth.bearerToken = "bearer-token", "fixed"
    assert c.headers("GET", "u") == {"Authorization": "Bearer fixed"}
    assert [base64url(x) for x in ("a", "ab", "abc", b"\xff\xfe")] == ["YQ", "YWI", "YWJj", "__4"]
