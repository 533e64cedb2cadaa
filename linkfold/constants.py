"""Vocabulary. All strings here are fixed values of the data formats."""

from __future__ import annotations

# Namespaces, in the order in which prefixes are tried.
PREFIXES = {
    "ad4m": "https://ad4m.dev/ontology#",
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "ldp": "http://www.w3.org/ns/ldp#",
    "acl": "http://www.w3.org/ns/auth/acl#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "dcterms": "http://purl.org/dc/terms/",
    "vcard": "http://www.w3.org/2006/vcard/ns#",
    "solid": "http://www.w3.org/ns/solid/terms#",
}


def term(prefix: str, local: str) -> str:
    return PREFIXES[prefix] + local


RDF_TYPE, RDF_SUBJECT, RDF_PREDICATE, RDF_OBJECT = (term("rdf", x) for x in ("type", "subject", "predicate", "object"))
XSD_STRING, XSD_DATETIME, XSD_INTEGER, XSD_DECIMAL, XSD_BOOLEAN = (term("xsd", x) for x in ("string", "dateTime", "integer", "decimal", "boolean"))
LINK, COMMIT, TOMBSTONE = (term("ad4m", x) for x in ("LinkExpression", "DiffCommit", "Tombstone"))
AUTHOR, TIMESTAMP, SIGNATURE, KEY = (term("ad4m", x) for x in ("author", "timestamp", "proofSignature", "proofKey"))
PREVIOUS, ADDITION, REMOVAL = (term("ad4m", x) for x in ("previous", "addition", "removal"))
LINK_HASH, REMOVES_HASH = (term("ad4m", x) for x in ("linkHash", "removesLinkHash"))
CONTAINS, CONTAINER = term("ldp", "contains"), term("ldp", "BasicContainer")
CREATOR, CREATED = term("dcterms", "creator"), term("dcterms", "created")
SUBJECT = term("ad4m", "Subject")

# The shape vocabulary.
NATIVE_TYPE, AUTHOR_FIELD, TIMESTAMP_FIELD, ID_FIELD = (f"projection://{x}" for x in ("nativeType", "authorField", "timestampField", "idField"))
FIELD, EXPRESSION = "projection://field", "projection://expression"
TARGET_CLASS, PROPERTY, PATH, DATATYPE, HAS_VALUE = (f"sh://{x}" for x in ("targetClass", "property", "path", "datatype", "hasValue"))
SHAPE_PREFIXES, SHAPE_TYPE = ("sh://", "projection://"), "rdf://type"
HAS_CHILD = "ad4m://has_child"

# Predicates of the pattern classifier.
CHAT = ("flux://has_message", "sioc://content_of")
REPLY = ("flux://has_reply", "sioc://reply_of")
REACTION = ("flux://has_reaction", "emoji://reaction")
CONTENT = "sioc://content_of"

# Media types.
TURTLE, N3, JSON_LD = "text/turtle", "text/n3", "application/ld+json"
