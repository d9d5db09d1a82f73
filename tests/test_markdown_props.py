"""Native section map and detectors against a direct Python model of the rules, on random markdown."""
from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sightline.operators import pages as PG

HEAD = re.compile(r"^(#{1,6})\s+(.+)$")


def model_sections(md: str):
    lines = md.split("\n")
    heads = [(i, m.group(2).strip()) for i, ln in enumerate(lines) if (m := HEAD.match(ln))]
    out = []
    for k, (i, title) in enumerate(heads):
        end = heads[k + 1][0] if k + 1 < len(heads) else len(lines)
        out.append((title, i + 1, len("\n".join(lines[i + 1:end])) // 4))
    return out


def model_fused(md: str, n: int):
    zones = [m.span() for p, f in (PG.FENCE_RE, PG.LINK_URL_RE, PG.INLINE_CODE_RE, PG.FRONT_MATTER_RE)
             for m in re.finditer(p, md, (re.M | re.S) if f else 0)]
    out = []
    for m in re.finditer(rf"\S{{{n},}}", md):
        if any(m.start() < ze and m.end() > zs for zs, ze in zones):
            continue
        s, e = max(0, m.start() - 40), min(len(md), m.end() + 40)
        out.append((md[: m.start()].count("\n") + 1, md[s:e].replace("\n", "\\n")))
    return out


LINE = st.one_of(
    st.sampled_from(["", " ", "```", "```python", "# Title", "## Sub  ", "###### deep", "#nospace", "plain text"]),
    st.text(alphabet="ab #`*[]()-\t", max_size=30),
    st.builds(lambda w: "word " + "x" * w, st.integers(5, 30)),
)


@settings(max_examples=1, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(LINE, max_size=25), min_size=40, max_size=40))
def test_sections_and_fused_match_model(spark, docs):
    texts = ["\n".join(d) for d in docs]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, markdown string")
    out = PG.section_map(PG.detect_issues(df, "markdown", min_len=8), "markdown").collect()
    for r in out:
        md = texts[r.doc_id]
        assert [(s.title, s.line, s.tokens) for s in r.sections] == model_sections(md)
        fused = [(i.line, i.find) for i in r.issues if i.type == "fused text"]
        assert fused == model_fused(md, 8)
