"""Trigram queries derived from patterns, and the secret scan of every rule against Python's matches."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adfunnel.llm import secrets, trigrams

ASCII = st.characters(max_codepoint=127)
PATTERNS = [r.pattern for r in secrets.RULES] + [
    "abc", "(?i)AbCd", "(abc|abd)e?f", "ab(c|d)*ef[gh]ij", "(foo){2}", "(foo){2,}bar", "(?:fo+)bar", "[ab]{3}", "[a-h]{4}x",
    "x?y?z?", "(abc|)def", "(?:abc)+?d", "^start.*end$", r"(?<=k)key\d+", r"(abc)\1def", "a{5}", "[^a]bcd", "(ab|[a-z])cde",
    "(?:[ab][cd][ef]){3}", "(abc.def|ghi)(jkl|mno.pqr)", r"\bword\b", "(?:one|two|three|four)(?:a|b|c)(?:x|y|z)(?:1|2|3)",
]


def answers(query, text):
    low = text.lower()
    return not query or any(all(g in low for g in clause) for clause in query)


@pytest.mark.parametrize("pattern", PATTERNS)
def test_every_match_answers_its_query(pattern):
    query = trigrams.derive(pattern)

    @settings(max_examples=60, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    @given(st.from_regex(re.compile(pattern, re.A), alphabet=ASCII))
    def check(text):
        assert answers(query, text)

    check()


@pytest.mark.parametrize("pattern,query", [
    ("abc", [["abc"]]),
    ("(?i)ABCD", [["abc", "bcd"]]),
    ("ab", []), ("[a-z]+", []), ("abc|x", []), ("(abc)?", []),
    ("abc|def", [["abc"], ["def"]]),
    ("ab[cd]", [["abc"], ["abd"]]),
    ("abc.*def", [["abc", "def"]]),
    ("(ab.*)(cd.*)ef", []),
    ("(x.*ab)(cd.*y)", [["abc", "bcd"]]),
    ("(foo)+", [["foo"]]), ("(foo)*bar", [["bar"]]),
    ("a(b|c)?d", []), ("aab?cc", [["aab", "bcc"], ["aac", "acc"]]),
    (secrets.RULES[1].pattern, [["aki", "kia"]]),
    (secrets.RULES[2].pattern, []),
])
def test_derived_queries(pattern, query):
    assert trigrams.derive(pattern) == query


def test_assignments_need_their_keywords():
    """Five clauses: what api_key demands, apikey's clause demands already."""
    query = trigrams.derive(secrets.RULES[0].pattern)
    assert len(query) == 5 and all(answers(query, f"x {k}= y") for k in ("PassWord", "passwd", "secret", "TOKEN", "api_key",
                                                                   "apikey"))
    assert not answers(query, "pass the word, keep it secre t")


def test_runs_take_the_length_test():
    assert secrets.Rule("hex", "([0-9a-f]+)", 0, 24).search() == "([0-9a-f]{24,})"
    assert secrets.Rule("two", "([a-f]+)([0-9]+)", 0, 24).search() == "([a-f]+)([0-9]+)"
    assert secrets.Rule("other", "([a-f]+x)", 0, 24).search() == "([a-f]+x)"


def test_every_rule_finds_its_matches(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----"
    texts = [None, "", "plain words", "ghp_" + "a1B2" * 9, "ghz_" + "a1B2" * 9, "x xoxb-123456789012 y", "xoxq-123456789012",
             "AIza" + "k" * 35, "AIza" + "k" * 34, "sk_live_" + "z9" * 8 + " rk_live_" + "z9" * 8, key, key.lower(),
             "-----BEGIN PRIVATE KEY-----", "é日本 ghs_" + "Q" * 40 + " TOKEN='abcdef'", "deadbeef" * 3, "deadbeef" * 2,
             "AKIA" + "Z" * 16 + "\n" + key * 2, "word " * 200_000 + "ghr_" + "b" * 36]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(3, texts[3], "repeated"), (None, texts[5], "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, [(s["start"], s["kind"], s["end"]) for s in r["spans"]])
                 for r in secrets.find_secrets(docs).collect())

    def spans(text):
        found = [(m.start(), i, r.kind, m.end()) for i, r in enumerate(secrets.RULES)
                 for m in re.finditer(r.pattern, text or "", re.A) if len(m[r.group]) >= r.least]
        return [(s, k, e) for s, _, k, e in sorted(found)]

    assert got == sorted((i is None, i or 0, spans(t)) for i, t, _ in rows)
    assert {k for g in got for _, k, _ in g[2]} == {r.kind for r in secrets.RULES}


def test_index_has_few_files_a_trigram(spark, tmp_path):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('password token secret ', id) AS text").repartition(16)
    secrets.write_index(docs, str(tmp_path / "index"))
    files = list((tmp_path / "index").rglob("*.parquet"))
    folders = {f.parent for f in files}
    assert len(folders) > 3 and len(files) <= 2 * len(folders)
