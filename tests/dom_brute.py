"""Pages as trees, built with a stack: what the interval operators are held against."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from sightline.operators import dom

SPACE = re.compile(r"^\s+|\s+$")


@dataclass(eq=False)
class Node:
    token: str
    kind: str
    name: str = ""
    pos: int = 0
    stop: int = 0
    parent: Node | None = None
    children: list = field(default_factory=list)
    close: str = ""

    def walk(self):
        for c in self.children:
            yield c
            yield from c.walk()

    def html(self) -> str:
        return self.token + "".join(c.html() for c in self.children) + self.close

    def elements(self, *names):
        return [n for n in self.walk() if n.is_element and (not names or n.name in names)]

    @property
    def is_element(self):
        return self.kind in ("open", "void", "raw")

    def texts(self):
        return [n.token for n in self.walk() if n.kind == "text"]

    def length(self):
        return sum(len(SPACE.sub("", plain(t))) for t in self.texts())

    def attr(self, name):
        inside = re.sub(r"^<[^\s/>]*|/?>$", "", self.token)
        for n, v in re.findall(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", inside):
            if n.lower() == name and v.strip("\"'") != "":
                return v.strip("\"'").strip()
        return None

    def classes(self):
        return (self.attr("class") or "").split()

    def remove(self):
        self.parent.children.remove(self)


def plain(t):
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = t.replace(a, b)
    return t


def split(html):
    tag = r"""(?:[^<>=]+|=\s*(?:"[^"]*"|'[^']*')|=)*"""
    return [m[0] for m in re.finditer(rf"(?is)<!--(?:.*?-->|.*)|<(script|style)\b{tag}>(?:.*?</\1\s*>|.*)|</?[a-z]{tag}>|<[!?][^<>]*>|[^<]+|<", html or "")]


def tree(html) -> Node:
    parts = ["", *split(html)]
    nodes = []
    for pos, t in enumerate(parts):
        m = re.match(r"</?([a-zA-Z][^\s/>]*)", t)
        name = m[1].lower() if m else ""
        if not name:
            kind = "other" if t.startswith(("<!", "<?")) else "text"
        elif t.startswith("</"):
            kind = "other" if name in dom.VOID else "close"
        else:
            kind = "raw" if name in ("script", "style") else "void" if name in dom.VOID or t.endswith("/>") else "open"
        nodes.append(Node(t, kind, name, pos))
    opened, paired = {}, set()  # by name
    for n in nodes:
        if n.kind == "open":
            opened.setdefault(n.name, []).append(n)
        elif n.kind == "close":
            if opened.get(n.name):
                paired |= {opened[n.name].pop(), n}
            else:
                n.kind = "stray"
    root = Node("", "root")
    stack = [root]

    def pop(at):
        top = stack.pop()
        top.stop = at
        return top

    for n in nodes:
        if n.kind == "close":
            while stack[-1] not in paired:
                pop(n.pos)
            pop(n.pos + 1).close = n.token
            continue
        rank = dom.RANK.get(n.name, 0 if n.name in dom.BLOCKS else None) if n.kind in ("open", "void") else None
        while rank is not None and stack[-1] is not root and stack[-1] not in paired and dom.RANK.get(stack[-1].name, 99) <= rank:
            pop(n.pos)
        n.parent = stack[-1]
        stack[-1].children.append(n)
        if n.kind == "open":
            stack.append(n)
        else:
            n.stop = n.pos + 1
    while len(stack) > 1:
        pop(len(parts))
    return root


def terminal_regions(root):
    for n in root.elements():
        words = [SPACE.sub("", t) for t in n.texts() if SPACE.sub("", t)]
        if n.kind == "open" and n.attr("role") == "region" and any(w in (n.attr("aria-label") or "").lower() for w in dom.TERMINAL_WORDS) and words and all(x in x.parent.children for x in up(n)):
            code = Node('<code class="language-text">', "open", "code", parent=n, close="</code>")
            code.children = [Node(" ".join(words), "text", parent=code)]
            n.token, n.close, n.children, n.name = "<pre>", "</pre>", [code], "pre"


def up(n):
    while n.parent is not None:
        yield n
        n = n.parent


def strip_boilerplate(root):
    for n in root.elements():
        if n.name in dom.STRIP_TAGS or n.attr("role") == "button":
            n.remove()


def strip_copy_ui(root):
    gone = [n for pre in root.elements("pre") if pre.parent is not root for n in pre.parent.elements() if {c.lower() for c in n.classes()} & set(dom.COPY_CLASSES)]
    for n in dict.fromkeys(gone):
        n.remove()


def clean_code_chrome(root):
    gone = []
    for pre in root.elements("pre"):
        if pre.parent is root or pre.parent.name in dom.OPEN_CONTAINERS:
            continue
        gone += [n for n in pre.parent.children if n.is_element and n is not pre and n.name not in ("code", "pre") and not n.elements("pre") and not n.length()]
    for n in dict.fromkeys(gone):
        n.remove()


def collapse_code_spans(root):
    for pre in root.elements("pre"):
        code = next((c for c in pre.elements("code") if c.kind == "open"), None)
        if code is None or not [s for s in code.elements("span") if s.kind == "open"]:
            continue
        lines = [s for s in code.elements("span") if s.kind == "open" and "line" in s.classes()]
        lines = [s for s in lines if not any(a in lines for a in up(s.parent))]
        line = lambda s: "".join("".join(c.texts()) if c.kind != "text" else c.token if c.token.strip() else "" for c in s.children)
        text = "\n".join(map(line, lines)) if lines else "".join(code.texts())
        kept = [c for c in code.classes() if c.startswith(dom.CODE_CLASSES)]
        if kept:
            code.token = f'<code class="{" ".join(kept)}">'
        code.children = [Node(text, "text", parent=code)]


def inline_spacing(root):
    for n in root.elements(*dom.INLINE):
        at = n.parent.children.index(n)
        prev = n.parent.children[at - 1] if at else None
        if prev is not None and prev.is_element and prev.name in dom.INLINE:
            a, b = "".join(prev.texts()), "".join(n.texts())
            if a and b and a[-1] not in " \n" and b[0] not in " \n":
                n.parent.children.insert(at, Node(" ", "text", parent=n.parent))


STEPS = (terminal_regions, strip_boilerplate, strip_copy_ui, clean_code_chrome, collapse_code_spans, inline_spacing)


def div_scores(root):
    return [(d, d.length() + 100 * sum(c.is_element and c.name == "p" for c in d.children)) for d in root.elements("div")]


def pick(root, wanted=None):
    first = lambda *names: next(iter(root.elements(*names)), None)
    if wanted:
        return "selector", wanted[0]
    for name in ("article", "main"):
        if first(name) and first(name).length() > 100:
            return name, first(name)
    scores = [(d, s) for d, s in div_scores(root) if s > 0]
    if scores:
        return "div", max(scores, key=lambda x: x[1])[0]
    return ("body", first("body")) if first("body") else ("document", root)
