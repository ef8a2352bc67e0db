"""Small XML helpers that run inside Arrow batches: well-formedness and child-element records.

Names are kept as written, prefixes included (documents are read without namespaces).
"""

from __future__ import annotations

import posixpath
import re
from collections.abc import Callable
from xml.etree import ElementTree as ET
from xml.parsers import expat

# element paths treat ":" as a namespace mark, so names carry another character inside
_COLON, _STAND_IN = ":", "ː"


class Unsafe(ValueError):
    """A document that needs more than itself to be read."""


def _reader() -> expat.XMLParserType:
    parser = expat.ParserCreate()

    def doctype(name, system_id, public_id, has_internal):
        if system_id or public_id:
            raise Unsafe("external DTD is not read")

    def entity(name, is_parameter, value, base, system_id, public_id, notation):
        if is_parameter or system_id or value is None or "&" in value:
            raise Unsafe(f"entity {name} is not a plain text entity")

    parser.StartDoctypeDeclHandler = doctype
    parser.EntityDeclHandler = entity
    return parser


def _read(parser, text: str) -> None:
    if text.startswith("﻿"):
        raise Unsafe("content is not allowed in prolog")
    parser.Parse(text, True)


def document(text: str) -> ET.Element:
    """Root element of a document."""
    builder = ET.TreeBuilder()
    parser = _reader()
    parser.StartElementHandler = lambda name, attrs: builder.start(name.replace(_COLON, _STAND_IN), attrs)
    parser.EndElementHandler = lambda name: builder.end(name.replace(_COLON, _STAND_IN))
    parser.CharacterDataHandler = builder.data
    parser.buffer_text = True
    _read(parser, text)
    return builder.close()


def element_path(path: str | None) -> str:
    """A location path in the form the element tree searches, below an outer node.

    Absolute paths start at the outer node, relative ones at the document element; no path is
    the document element. Steps may be names, ``*``, ``.``, ``//`` and simple predicates.
    """
    path = (path or "").strip().replace("child::", "")
    path = re.sub(r"(?<=[\w.-]):(?=[\w])", _STAND_IN, path)
    if path.startswith("/"):
        found = f".{path}"
    elif path in ("", "."):
        found = "./*"
    else:
        found = f"./*/{path}"
    try:
        ET.Element("x").findall(found)
    except (SyntaxError, KeyError, TypeError) as error:
        raise ValueError(f"location path not understood: {path!r}: {error}") from None
    return found


# a path of plain element steps, perhaps to an attribute at the end
_PLAIN = re.compile(r"^(?P<steps>(?://?(?:[A-Za-z_][\w.-]*|\*))+)(?:/@(?P<attribute>[A-Za-z_][\w.-]*))?$")


def plain_path(path: str) -> tuple[str, str | None] | None:
    """The path as (element path, attribute) if it is an absolute one of plain steps."""
    found = _PLAIN.match(path.strip())
    return (f".{found['steps']}", found["attribute"]) if found else None


def _in_order(outer: ET.Element, path: str) -> list[ET.Element]:
    """The nodes at a path, each once, in document order."""
    found = {id(node) for node in outer.iterfind(path)}
    return [node for node in outer.iter() if id(node) in found]


def text_at(text: str | None, path: str | None) -> tuple[str | None, str | None]:
    """Text of the first match of a path that is known per row only, or what is wrong."""
    if not text:
        return None, "no XML"
    try:
        found = plain_path(path or "")
        if found is None:
            found = (element_path(path), None)
        outer = ET.Element("outer")
        outer.append(document(text))
        if found[1] is not None:
            held = (node.get(found[1]) for node in _in_order(outer, found[0]))
            return next((value for value in held if value is not None), ""), None
        nodes = _in_order(outer, found[0])
    except (expat.ExpatError, ValueError) as error:
        return None, str(error)
    return "".join(nodes[0].itertext()) if nodes else "", None


# a path that the element tree reads as XPath does: named steps with one plain predicate at most
_STEP = r"(?:\*|[A-Za-z_][\w.-]*(?::[\w.-]+)?(?:\[(?:[1-9]\d*|@[A-Za-z_][\w.-]*(?:='[^']*')?)\])?)"
_SIMPLE = re.compile(rf"^(?://?)?{_STEP}(?://?{_STEP})*$")


def simple_path(path: str | None) -> bool:
    """Whether :func:`element_path` gives the nodes that XPath gives."""
    path = (path or "").strip().replace("child::", "")
    return path in ("", ".") or _SIMPLE.match(path) is not None


# a name with a prefix; what is quoted is matched first and stays
_PREFIXED = re.compile(r"""("[^"]*"|'[^']*')|(?<![\w.-])(?<!\w:)(@?)([A-Za-z_][\w.-]*:[A-Za-z_][\w.-]*)(?![\w.-]*(?:\(|::))""")


def from_document(path: str) -> str:
    """An XPath asked of the document element, as one asked of the document; prefixes are parts of names.

    A path in parentheses starts where it says itself.
    """
    out = _PREFIXED.sub(lambda m: m[1] or f"{m[2]}*[name()='{m[3]}']", path.strip())
    parts, depth, quote, start = [], 0, "", 0
    for i, c in enumerate(out):
        if quote:
            quote = "" if c == quote else quote
        elif c in "'\"":
            quote = c
        elif c in "[(":
            depth += 1
        elif c in "])":
            depth -= 1
        elif c == "|" and depth == 0:
            parts.append(out[start:i])
            start = i + 1
    parts = [x.strip() for x in [*parts, out[start:]]]
    return " | ".join(x if x.startswith(("/", "(")) else f"/*/{x}" for x in parts)


def records(text: str | None, path: str, children: bool) -> tuple[list | None, str | None]:
    """(name, text) pairs of the child elements of every record node, or the reason for none.

    Records are the nodes at ``path`` or, with ``children``, their child elements.
    """
    if not text:
        return None, "no XML"
    try:
        outer = ET.Element("outer")
        outer.append(document(text))
    except (expat.ExpatError, Unsafe) as error:
        return None, str(error)
    nodes = _in_order(outer, path)
    if children:
        nodes = [child for node in nodes for child in node]
    return [_fields(node) for node in nodes], None


def records_at(text: str, places: list[int]) -> tuple[list | None, str | None]:
    """As :func:`records`, of the elements that start at these places of the document, counted from 1."""
    try:
        nodes = list(document(text).iter())
    except (expat.ExpatError, Unsafe) as error:
        return None, str(error)
    return [_fields(nodes[k - 1]) for k in places], None


def _fields(node: ET.Element) -> list[tuple[str, str]]:
    return [(field.tag.replace(_STAND_IN, _COLON), "".join(field.itertext())) for field in node]


#: Fixed value: the namespace of schemas.
XSD_NAMESPACE = "http://www.w3.org/2001/XMLSchema"


def schema_set(paths: list[str], load: Callable[[str], str], place: Callable[[int], str]) -> list[str]:
    """Schema texts, one for every target namespace of some files and of what they include and import.

    A shipped file cannot find its neighbours, so includes are replaced by what they include, and
    imports lead to ``place(k)``, the name of the k-th text. Of several texts the first only imports
    the others. Every file's namespace prefixes stay with its own declarations.
    """
    merged: dict[str, ET.Element] = {}
    imports: dict[str, dict[str, str]] = {}  # per namespace, the imported ones and the tag that does it
    seen: set[str] = set()

    def beside(path: str, part: ET.Element) -> str:
        location = part.get("schemaLocation", "").removeprefix("./")
        return location if ":/" in location else posixpath.join(posixpath.dirname(path), location)

    def take(path: str, expected: str | None = None) -> None:
        if path in seen:
            return
        seen.add(path)
        root = document(load(path))
        prefixes = {k: v for k, v in root.attrib.items() if k == "xmlns" or k.startswith("xmlns:")}
        settings = {k: v for k, v in root.attrib.items() if k not in prefixes}
        space = settings.get("targetNamespace", "")
        if expected is not None and space != expected:
            raise ValueError(f"{path} has the target namespace {space!r}, not {expected!r}")
        if space not in merged:
            merged[space], imports[space] = ET.Element(root.tag, {**prefixes, **settings}), {}
        for name in ("elementFormDefault", "attributeFormDefault"):
            if merged[space].get(name) != settings.get(name):
                raise ValueError(f"{path} differs in {name}")
        for part in root:
            kind = part.tag.rsplit(_STAND_IN, 1)[-1]
            if kind == "include":
                take(beside(path, part), space)
            elif kind == "import":
                other = part.get("namespace", "")
                imports[space].setdefault(other, f"{root.tag.removesuffix('schema')}import")
                if part.get("schemaLocation"):
                    take(beside(path, part), other)
            elif kind in ("redefine", "override"):
                raise ValueError(f"{path} has {kind}, which is not read")
            else:
                part.attrib.update({k: v for k, v in prefixes.items() if k not in part.attrib})
                merged[space].append(part)

    for path in paths:
        take(path)
    several = len(merged) > 1
    places = {space: place(k + several) for k, space in enumerate(merged)}

    def leading(tag: str, space: str) -> ET.Element:
        found = {"namespace": space, "schemaLocation": places.get(space, "")}
        return ET.Element(tag, {k: v for k, v in found.items() if v})

    for space, schema in merged.items():
        for other, tag in imports[space].items():
            schema.insert(0, leading(tag, other))
    texts = list(merged.values())
    if several:
        first = ET.Element("x:schema", {"xmlns:x": XSD_NAMESPACE, "targetNamespace": f"urn:{place(0)}"})
        first.extend(leading("x:import", space) for space in merged)
        texts = [first, *texts]
    for schema in texts:
        for element in schema.iter():
            element.tag = element.tag.replace(_STAND_IN, _COLON)
    return [ET.tostring(schema, encoding="unicode") for schema in texts]
