"""Converters from document formats to plain text. Each is a plain function of one text; ``to_text`` applies the one that a
file's extension names in an Arrow batch. A format that can't be read gives a status instead of a text.

Own readings of the formats: void tags never open a skipped region, and skip classes match whole words.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from html import unescape
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Tags and class words whose content is no text.
SKIP_TAGS = frozenset("script style nav header footer aside noscript form button input iframe svg".split())
SKIP_WORDS = frozenset("nav navbar menu sidebar footer header breadcrumb toc ad ads advertisement cookie banner".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNDERLINE = {"h1": "=", "h2": "-"}


class _Html(HTMLParser):
    def __init__(self) -> None:
        super().__init__()
        self.out: list[str] = []
        self.skip: list[str] = []
        self.lists: list[int] = []
        self.pre = 0
        self.head: tuple[str, int] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in VOID:
            if tag == "br" and not self.skip:
                self.out.append("\n")
            return
        words = {w for k, v in attrs if k in ("class", "id") and v for w in re.findall(r"[a-z]+", v.lower())}
        if self.skip or tag in SKIP_TAGS or words & SKIP_WORDS:
            self.skip.append(tag)
            return
        if re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n")
            self.head = (tag, len(self.out))
        elif tag in ("p", "div", "section", "article", "table", "tr", "blockquote"):
            self.out.append("\n\n" if tag != "tr" else "\n")
        elif tag in ("ul", "ol"):
            self.lists.append(0 if tag == "ul" else 1)
            self.out.append("\n")
        elif tag == "li":
            n = self.lists[-1] if self.lists else 0
            self.out.append(f"\n{n}. " if n else "\n- ")
            if n:
                self.lists[-1] += 1
        elif tag == "pre":
            self.pre += 1
            self.out.append("\n\n[CODE]\n")
        elif tag in ("td", "th"):
            self.out.append(" ")

    def handle_endtag(self, tag):
        if self.skip:
            if tag in self.skip:
                while self.skip.pop() != tag:
                    pass
            return
        if self.head and tag == self.head[0]:
            title = " ".join("".join(self.out[self.head[1] :]).split())
            del self.out[self.head[1] :]
            self.out += [title, "\n" + _UNDERLINE[tag] * len(title) if tag in _UNDERLINE else "", "\n\n"]
            self.head = None
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
            self.out.append("\n")
        elif tag == "pre" and self.pre:
            self.pre -= 1
            self.out.append("\n[/CODE]\n\n")
        elif tag in ("p", "div", "table"):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.skip:
            self.out.append(data if self.pre else re.sub(r"\s+", " ", data))


def _tidy(text: str) -> str:
    lines = [x.rstrip() for x in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(x if x.startswith(" " * 4) else x.lstrip() for x in lines)).strip()


def html(text: str) -> str:
    p = _Html()
    p.feed(text)
    p.close()
    return _tidy("".join(p.out))


def _inline(text: str) -> str:
    text = re.sub(r"!\[([^\]]*)\]\([^)]*\)", r"\1", text)
    text = re.sub(r"\[([^\]]+)\]\([^)]*\)", r"\1", text)
    text = re.sub(r"\[([^\]]+)\]\[[^\]]*\]", r"\1", text)
    text = re.sub(r"(\*\*|__)(.+?)\1", r"\2", text)
    text = re.sub(r"(?<!\w)[*_]([^*_]+)[*_](?!\w)", r"\1", text)
    return unescape(re.sub(r"<[^>]+>", "", re.sub(r"`([^`]+)`", r"\1", text)))


def markdown(text: str) -> str:
    out, fence = [], False
    lines = text.split("\n")
    for i, line in enumerate(lines):
        if re.match(r"\s*(```|~~~)", line):
            fence = not fence
            out.append("[CODE]" if fence else "[/CODE]")
        elif fence or line.startswith("    "):
            out.append(line)
        elif m := re.match(r"(#{1,6})\s+(.*?)\s*#*$", line):
            title = _inline(m[2])
            out += ["", title] + [{1: "=", 2: "-"}[len(m[1])] * len(title)] * (len(m[1]) < 3)
        elif re.fullmatch(r"\s*([-*_])(\s*\1){2,}\s*", line) and not (i and lines[i - 1].strip()):
            out.append("")
        else:
            out.append(_inline(re.sub(r"^\s*[*+]\s+", "- ", re.sub(r"^\s*>\s?", "", line))))
    return _tidy("\n".join(out))


def rst(text: str) -> str:
    out, skip = [], None
    for line in text.split("\n"):
        indent = len(line) - len(line.lstrip())
        if skip is not None and (not line.strip() or indent > skip):
            continue
        skip = None
        if m := re.match(r"(\s*)\.\.\s+(code-block|code|sourcecode)::", line):
            out.append("[CODE]")
        elif m := re.match(r"(\s*)\.\.\s+(note|warning|tip|important)::\s*(.*)", line):
            out.append(f"{m[2].title()}: {m[3]}".rstrip(": "))
        elif m := re.match(r"(\s*)\.\.(\s|$)", line):
            skip = len(m[1])
        else:
            line = re.sub(r":[a-z:]+:`([^`<]+?)(?:\s*<[^>]*>)?`", r"\1", line)
            line = re.sub(r"`([^`<]+?)\s*<[^>]*>`_+", r"\1", re.sub(r"``([^`]+)``", r"\1", line))
            out.append(re.sub(r"(\*\*|\*)(\S(?:.*?\S)?)\1", r"\2", re.sub(r"::\s*$", ":", line)))
    return _tidy("\n".join(out))


def man(text: str) -> str:
    """Roff macros of manual pages; no outside program."""
    out, plain = [], lambda s: re.sub(r"\\f.|\\[&|^]", "", s).replace(r"\-", "-").replace(r"\(bu", "-").replace(r"\e", "\\")
    for line in text.split("\n"):
        if line.startswith((".\\\"", "'\\\"")):
            continue
        m = re.match(r"[.'](\w+)\s*(.*)", line)
        if not m:
            out.append(plain(line))
            continue
        name, rest = m[1], plain(m[2]).replace('"', "")
        if name == "TH":
            out.append(rest.split()[0] if rest else "")
        elif name == "SH":
            out += ["", rest.upper(), ""]
        elif name == "SS":
            out += ["", rest, ""]
        elif name in ("PP", "P", "LP", "TP", "IP", "sp"):
            out += ["", rest] if rest and name == "IP" else [""]
        elif name in ("B", "I", "BR", "IR", "RB", "RI", "BI", "IB"):
            out.append(rest)
    return _tidy("\n".join(out))


def rfc_xml(text: str) -> str:
    root = ElementTree.fromstring(text)
    out: list[str] = []

    def words(node) -> str:
        return " ".join("".join(node.itertext()).split())

    def walk(node, level):
        for child in node:
            tag = child.tag.rpartition("}")[2]
            if tag == "section":
                title = child.get("title") or next((words(n) for n in child if n.tag == "name"), "")
                out.extend(["", title, ("=" if level < 2 else "-") * len(title), ""])
                walk(child, level + 1)
            elif tag == "t" and not list(child.iter("list")):
                out.extend([words(child), ""])
            elif tag in ("artwork", "sourcecode"):
                out.extend(["[CODE]", child.text or "", "[/CODE]", ""])
            elif tag == "li":
                out.append("- " + words(child))
            elif tag == "reference":
                out.append("[" + (child.get("anchor") or "") + "] " + words(child))
            elif tag == "title":
                out.extend([words(child), ""])
            elif tag != "name":
                walk(child, level)

    walk(root, 1)
    return _tidy("\n".join(out))


def texinfo(text: str) -> str:
    text = re.sub(r"@ignore\b.*?@end ignore", "", text, flags=re.S)
    out = []
    for line in text.split("\n"):
        if m := re.match(r"@(chapter|unnumbered|appendix|section|subsection|top|heading)\s+(.*)", line):
            out += ["", m[2], ("=" if m[1] in ("chapter", "top", "unnumbered", "appendix") else "-") * len(m[2]), ""]
        elif re.match(r"@(item|itemx)\b", line):
            out.append("- " + line.partition(" ")[2])
        elif re.match(r"@(example|verbatim|lisp)\b", line):
            out.append("[CODE]")
        elif re.match(r"@end (example|verbatim|lisp)", line):
            out.append("[/CODE]")
        elif not re.match(r"@(c|comment|end|node|menu|set|clear|include|setfilename|settitle|cindex|findex|vindex|page|bye|itemize|enumerate|table)\b|\\input", line):
            out.append(line)
    body = "\n".join(out)
    while (new := re.sub(r"@\w+\{([^{}]*)\}", r"\1", body)) != body:
        body = new
    return _tidy(body.replace("@@", "@").replace("@{", "{").replace("@}", "}"))


def _comment(block: str) -> str:
    body = "\n".join(re.sub(r"^\s*\*? ?", "", x) for x in block.split("\n"))
    body = re.sub(r"\{@(?:link|code|literal)\s+([^}]*)\}", r"\1", body)
    body = re.sub(r"^@param\s+(?:\{[^}]*\}\s*)?(\S+)\s*", r"Parameter \1: ", body, flags=re.M)
    body = re.sub(r"^@returns?\s*(?:\{[^}]*\}\s*)?", "Returns: ", body, flags=re.M)
    body = re.sub(r"^@throws\s+(\S+)\s*", r"Throws \1: ", body, flags=re.M)
    return re.sub(r"<[^>]+>", "", body).strip()


def javadoc(text: str) -> str:
    """Comments of at least 20 characters with the declaration that follows within 500."""
    out = []
    for m in re.finditer(r"/\*\*(.*?)\*/", text, re.S):
        body = _comment(m[1])
        if len(body) >= 20:
            after = re.match(r"\s*(?:@\w+(?:\([^)]*\))?\s*)*([^;{]+)", text[m.end() : m.end() + 500])
            out.append(f"{' '.join(after[1].split())}\n\n{body}" if after else body)
    return "\n\n---\n\n".join(out)


def go_docs(text: str) -> str:
    """Comments directly above declarations, line or block, with the declared name."""
    out = []
    for m in re.finditer(r"((?:^//.*\n)+|^/\*.*?\*/\s*\n)(func|type|var|const|package)\s+(?:\([^)]*\)\s*)?(\w+)", text, re.M | re.S):
        body = "\n".join(re.sub(r"^\s*(//|/\*|\*/)\s?", "", x) for x in m[1].strip().split("\n")).replace("*/", "").strip()
        out.append(f"{m[3]}\n\n{body}")
    return "\n\n---\n\n".join(out)


def ts_docs(text: str) -> str:
    return "\n\n---\n\n".join(b for m in re.finditer(r"/\*\*(.*?)\*/", text, re.S) if len(b := _comment(m[1])) > 50)


def threat_json(text: str) -> str:
    """Names and descriptions of the objects of a threat catalogue."""
    kinds = {"attack-pattern", "malware", "tool", "intrusion-set", "course-of-action"}  # fixed values: object types
    data = json.loads(text)
    found = [o for o in (data.get("objects", []) if isinstance(data, dict) else []) if o.get("type") in kinds and o.get("name") and o.get("description")]
    return "\n\n---\n\n".join(f"{o['name']}\n\n{o['description']}" for o in found)


def yaml_docs(text: str) -> str:
    """Values of documentation keys: block scalars over 30 characters, single values over 20."""
    out, lines, i = [], text.split("\n"), 0
    while i < len(lines):
        m = re.match(r"(\s*)(?:-\s+)?(description|summary|title|documentation|notes|doc|comment):\s*(.*)", lines[i])
        i += 1
        if not m:
            continue
        if re.fullmatch(r"[|>][+-]?\d*", m[3]):
            block = []
            while i < len(lines) and (not lines[i].strip() or len(lines[i]) - len(lines[i].lstrip()) > len(m[1])):
                block.append(lines[i].strip())
                i += 1
            value = "\n".join(block).strip()
            out += [value] * (len(value) > 30)
        else:
            value = m[3].strip().strip("\"'")
            out += [value] * (len(value) > 20)
    return "\n\n".join(out)


#: Extension to converter; register() adds to it.
CONVERTERS: dict[str, Callable[[str], str]] = {
    "html": html, "htm": html, "md": markdown, "markdown": markdown, "rst": rst, "xml": rfc_xml, "texi": texinfo, "texinfo": texinfo,
    "java": javadoc, "go": go_docs, "ts": ts_docs, "json": threat_json, "yaml": yaml_docs, "yml": yaml_docs, "txt": str, "text": str,
    **{str(n): man for n in range(1, 10)}, "man": man,
}


def register(extension: str, converter: Callable[[str], str]) -> None:
    """A converter for an extension, for all later queries of this process."""
    CONVERTERS[extension.lower()] = converter


def to_text(text: Column, path: Column, converters: dict[str, Callable[[str], str]] | None = None) -> Column:
    """Struct of text and status (ok, empty, unsupported:ext or error:type) by the path's extension."""
    table = dict(CONVERTERS if converters is None else converters)

    @F.pandas_udf("text string, status string")
    def run(texts: pd.Series, paths: pd.Series) -> pd.DataFrame:
        rows = []
        for t, p in zip(texts, paths, strict=True):
            ext = (p or "").rpartition(".")[2].lower()
            f = table.get(ext)
            if t is None or f is None:
                rows.append((None, "empty" if t is None else f"unsupported:{ext}"))
                continue
            try:
                out = f(t)
                rows.append((out, "ok" if out.strip() else "empty"))
            except Exception as e:  # a broken document is a result, not a failure of the job
                rows.append((None, f"error:{type(e).__name__}"))
        return pd.DataFrame(rows, columns=["text", "status"])

    return run(text, path)
