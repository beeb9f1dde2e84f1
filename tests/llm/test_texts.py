"""Secrets, licenses, pages and toxicity against plain rules and planted cases."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.llm import html, licenses, queries, secrets, toxicity

KEY = "AKIA" + "ABCDEFGH12345678"
LONG_HEX = "0123456789abcdef" * 3


def plain(text):
    """The base rules by a loop over the text."""
    text, out = text or "", []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append(("assign", m.start(), m.end()))
    for kind, runs, least in (("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)):
        out += [(kind, m.start(), m.end()) for m in re.finditer(runs, text) if len(m[0]) >= least]
    return out


SECRET_TEXTS = [
    None,
    "",
    "password=short",
    "PASSWORD = 'longer-than-8'",
    "password=abc secret:abcdefgh1",
    "password=secret:abcdefghij",
    "toKen=abcdefgh Api_Key:abcdefgh apiKEY==abcdefgh",
    f"x{KEY}y {KEY}é AKIA AKIAAKIAAKIAAKIA",
    f"{LONG_HEX}g{LONG_HEX[:31]}g{LONG_HEX[:32]}",
    "toKen=abcdefghi ſecret=abcdefghi",
    "é" * 70_000 + " token=abcdefghij",
]


def test_base_spans():
    for text in SECRET_TEXTS:
        assert sorted(secrets.find(text)[0]) == sorted(plain(text)), text
    assert secrets.find("toKen=abcdefghi ſecret=abcdefghi") == ([], [])


def test_weak_parts_count_beside_complementary_ones():
    weak_key = "Zx9" + "aB3dE5gH7jK9mN1pQ3"
    assert secrets.find(f"key {weak_key} alone")[1] == []
    assert secrets.find("see https://example.org and user: bob")[1] == []
    text = f"user: bob and {weak_key} at https://example.org"
    assert {k for k, *_ in secrets.find(text)[1]} == {"identifier", "key", "endpoint"}
    apart = f"user: bob\n\n{weak_key}"
    assert secrets.find(apart)[1] == []
    far = f"user: bob {'filler ' * 100}{weak_key}"
    assert [k for k, *_ in secrets.find(far)[1]] == ["identifier", "key"]
    lines = "\n".join(["login=alice", *(f"line {i} of a log" for i in range(60)), "password=abcdefgh1"])
    assert [k for k, *_ in secrets.find(lines)[1]] == ["identifier"]
    inside = " ".join([LONG_HEX] * 12)
    long = f"token={'x' * 3000}"  # a far end counts, however many parts come after the start
    assert [k for k, *_ in secrets.find(f"{long} {inside} login=alice")[1]] == ["identifier"]
    beside = secrets.find(f"login=alice password=abcdefgh1")
    assert [k for k, *_ in beside[0]] == ["assign"] and [k for k, *_ in beside[1]] == ["identifier"]


def test_redaction():
    text = f"a password=abcdefgh1 b {KEY} c {LONG_HEX} d"
    assert secrets.redacted(text, "*") == "a password=* b * c * d"
    assert secrets.redacted(None, "*") is None and secrets.redacted("", "*") == ""
    assert secrets.find(secrets.redacted(text, "[REDACTED]"))[0] == []


def test_secret_query(spark, tmp_path):
    rows = [(i, t, "x") for i, t in enumerate(SECRET_TEXTS)] + [(1, "", "y"), (None, "token=abcdefgh1 user: bob", "z")]
    spark.createDataFrame(rows, "doc_id long, text string, spans string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_secrets(spark, str(tmp_path)).collect()
    assert len(found) == len(rows)
    for r in found:
        base = [x for x in r.spans.split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert len(base) == r.n_assign + r.n_access + r.n_hex
        assert spark.range(1).select(F.sha2(F.lit(",".join(base)).cast("binary"), 256)).first()[0] == r.base_sha256
    last = next(r for r in found if r.doc_id is None)
    assert last.spans == "assign:0:15,identifier:22:25"


def test_licenses(spark):
    notice = licenses.TEMPLATES[1][1]
    wrapped = notice.replace(" ", "\n", 30)
    changed = "Licensed under the Apache License, Version 1.1."
    texts = {
        1: None,
        2: "",
        3: f"prose here\n{notice}\nmore prose",
        4: f"{wrapped} and on",
        5: changed,
        6: "the license plate was lost with permission",
        7: "Released under the MIT License.\nx\nAll rights reserved. Licensed under CC BY-NC 4.0.",
        8: "word " * 40_000 + "\nReleased under the MIT License.",
    }
    rows = [(i, t, "c") for i, t in texts.items()] + [(5, changed, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = licenses.scan(docs).collect()
    assert sorted((r.doc_id, r.license, r.differences) for r in found) == [
        (3, "Apache-2.0", 0),
        (4, "Apache-2.0", 0),
        (5, "Apache-2.0", 1),
        (5, "Apache-2.0", 1),
        (7, "CC-BY-NC-4.0", 0),
        (7, "MIT", 0),
        (7, "Proprietary", 0),
        (8, "MIT", 0),
    ]
    for r in found:
        if r.differences == 0:
            words = [w for w, *_ in licenses.words_of(texts[r.doc_id][r.start : r.end])]
            assert words in [[w for w, *_ in licenses.words_of(t)] for _, t in licenses.TEMPLATES]
    assert licenses.scan(docs.limit(0)).collect() == []


def test_notices_anywhere_in_a_line_and_wrapped_anywhere():
    scan = licenses.scanner(licenses.TEMPLATES).find
    line = "word " * 40_000 + "Released under the MIT License. " + "word " * 300 + "All rights reserved."
    assert [(f[0], line[f[1] : f[2]]) for f in scan(line)] == [("MIT", "Released under the MIT License"), ("Proprietary", "All rights reserved")]
    for name, text in licenses.TEMPLATES:
        words = text.split()
        for at in range(len(words)):
            wrapped = f"some prose {' '.join(words[:at])}\n{' '.join(words[at:])} more prose"
            assert [(f[0], f[4]) for f in scan(wrapped)] == [(name, 0)], (name, at)
        assert [(f[0], f[4]) for f in scan(f"prose\n{text.replace(' ', chr(10) + ' * ')}\nprose")] == [(name, 0)]


def test_prose_after_a_notice_and_other_names():
    scan = licenses.scanner(licenses.TEMPLATES).find
    rng = random.Random(6)
    shared = [w for _, t in licenses.TEMPLATES for w in (" ".join(t.split()[i : i + 4]) for i in range(0, len(t.split()), 4))]
    for text, name in (("All rights reserved.", "Proprietary"), ("Released under the BSD License.", "BSD")):
        for _ in range(40):
            prose = " - ".join(f"{rng.choice(shared)} {rng.random()}" for _ in range(25))
            assert (name, 0) in [(f[0], f[4]) for f in scan(f"{text} {prose}")], prose
    for other in (
        "Released under the Artistic License.",
        "Licensed under CC BY 3.0.",
        "Licensed under CC BY SA 4.0.",
        "This work is licensed under the GNU General Public License, version 1.",
        licenses.TEMPLATES[10][1].replace("GNU General", "GNU Affero General"),
    ):
        assert scan(other) == [], other
    for same, name in (
        ("Released under the BSD (or Artistic, EPL, ...) License", "BSD"),
        ("Released under an MIT License.", "MIT"),
        ("This work is licensed under the GNU General Public License, version 3.0.", "GPL-3.0"),
        ("This work was licensed under the GNU Lesser General Public License, version 3.", "LGPL-3.0"),
    ):
        assert [(f[0], f[4]) for f in scan(same)] == [(name, 1)], same


def test_ends_of_runs_are_those_of_the_table():
    rng = random.Random(5)
    made = licenses.Scanner((("A", "a b c d e"), ("B", "a b c d e f g h i j")))
    for _ in range(300):
        words = [rng.choice("abcdefghijxy") if rng.random() < 0.3 else "abcdefghij"[k % 10] for k in range(rng.randint(1, 25))]
        numbers = np.array([made.numbers.get(w, 0) for w in words])
        for i, (_, template) in enumerate(made.templates):
            row = licenses._last_row(template, words)
            assert list(made._ends(i, numbers)) == [(c, at) for at, (c, _) in enumerate(row) if c <= made.allowed[i]]


def test_the_bytes_that_a_template_saves_decide(monkeypatch):
    """A long notice with changes saves more than the short one inside it, which has none."""
    words = licenses.TEMPLATES[1][1].split()
    text = " ".join("other" if i in (20, 40) else w for i, w in enumerate(words))
    made = licenses.Scanner(licenses.TEMPLATES)
    assert [(f[0], f[4], f[5]) for f in made.find(text)] == [("Apache-2.0", 2, len(licenses.words_of(text)))]
    assert made.ranking([w for w, *_ in licenses.words_of(text)])[0] == 1
    monkeypatch.setattr(made, "reduction", lambda i, words: 0)
    assert [(f[0], f[4], f[5]) for f in made.find(text)] == [("Apache-2.0", 0, 7)]


def test_differences_are_the_fewest():
    rng = random.Random(4)

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j - 1] + (x != y), last[j] + 1, row[j - 1] + 1))
        return row[-1]

    for _ in range(60):
        a, b = [[rng.choice("abc") for _ in range(rng.randint(1, 6))] for _ in range(2)]
        cost, low, high = licenses.differences(a, b)
        best = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert cost == best and (cost == len(a) or distance(a, b[low:high]) == cost)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head><body>
<header><h1>Site</h1><nav><ul><li><a href=/>Home, and, more, links</a></ul></nav></header>
<div class="cookie-notice"><p>We use cookies, yes, we, do, so, accept them.</p></div>
<div id="page"><aside><p>side, bar, text, that, goes, on</p></aside>
<div class="post"><h1>Title &amp; more</h1><p>First &lt;b&gt;,
  with   commas, and <b>bold<p>Second <a href="x">link</a>, ok.<br>Same block &#233;.</p>
<ul class="menu"><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>
<ul><li>An item, plain<li>Another</ul><form><p>Your name, please</p></form></div>
<div class="ad">Buy, buy, buy, buy, buy, buy</div>
<section id="comments"><p>A reader, says, a lot, of, things, here.</p></section></div>
<footer>foot, er</footer></body></html>"""


def test_main_text():
    assert html.main_blocks(PAGE) == [
        "Title & more",
        "First <b>, with commas, and bold",
        "Second link, ok. Same block é.",
        "An item, plain",
        "Another",
    ]
    assert html.main_blocks(None) == html.main_blocks("") == html.main_blocks("<nav>a</nav>") == []
    assert html.main_blocks("no markup, a < b") == ["no markup, a < b"]
    article = f"<body>{'<p>x, y, z</p>' * 20}<article><h1>A</h1><section><p>b</p></section></article><p>c</p>"
    assert html.main_blocks(article) == ["A", "b"]
    deep = "<div>" * 3000 + "<p>deep, text</p>"
    assert html.main_blocks(deep) == ["deep, text"]
    long = f"<article>{'<p>' + 'word ' * 20_000 + '</p>'}</article>"
    assert html.main_blocks(long) == [("word " * 20_000).strip()]


def test_plain_divs_keep_a_lead_and_a_short_last_part():
    long = "".join(f"<p>Part {i}, with commas, more, and {'words ' * 60}</p>" for i in range(8))
    menu = "<div><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div><div class=cookie-notice><p>We use cookies</p></div>"
    inner = f"<p>A lead.</p><div>{long}</div>Bare text.<p>Between.</p><div><p>Last, short.</p></div>"
    for page in (f"<body>{menu}<div>{inner}</div></body>", f"<body>{menu}{inner}</body>", inner.replace("<div><p>Part 0", "<div><div><p>Part 0")):
        found = html.main_blocks(page)
        assert found[0] == "A lead." and found[-3:] == ["Bare text.", "Between.", "Last, short."] and len(found) == 12, found
    sources = "".join(f"<li><a href={i}>A long title of a source that the article names, {i}</a>" for i in range(4))
    found = html.main_blocks(f"<article>{long}<ul>{sources}</ul><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>x</a></ul></article>")
    assert len(found) == 12 and found[-1].endswith("names, 3")


@pytest.mark.parametrize(
    "around",
    [
        '<article class="post has-comments comments-open">{}</article>',
        '<div class="post-content comments-open">{}</div>',
        '<section class="discussion">{}</section>',
        '<div class="has-sidebar">{}</div>',
        '<div class="layout right sidebar-right">{}</div>',
        '<form id="aspnetForm" action="/x">{}<input name="q"><button>Go</button></form>',
        '<div class="no-banner header-fixed footer-dark cookie-bar-open"><div id="page" class="menu-collapsed">{}</div></div>',
        '<body class="modal-ready"><div class="widget-area-off social-on"><main>{}</main></div>',
    ],
)
def test_state_words_lose_no_article(around):
    story = "".join(f"<p>Paragraph {i}, which is long enough, with commas, to be read.</p>" for i in range(6))
    side = '<div class="sidebar"><p>Read this, too.</p></div><form><p>Sign up</p></form><div class="cookie-notice">We use cookies.</div>'
    comments = "".join(f'<div class="comment-{i}"><p>I think, no.</p></div>' for i in range(3))
    page = f'<html><body><nav>Menu</nav>{around.format(story)}{side}<div id="comments">{comments}</div></body></html>'
    assert html.main_blocks(page) == [f"Paragraph {i}, which is long enough, with commas, to be read." for i in range(6)]


def test_comments_go_however_long_they_are():
    story = "<p>A short story, but the story.</p>"
    for names in ("comments", "comment-list", "post-comments", "comments-area", "disqus_thread", "respond"):
        many = "".join(f"<p>Reader {i}, at length, has this and that to say about it.</p>" for i in range(9))
        assert html.main_blocks(f'<article>{story}</article><section class="{names}">{many}</section>') == ["A short story, but the story."]


def test_html_query(spark, tmp_path):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p>a&nbsp;b</p>", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string, text string").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op5_html(spark, str(tmp_path)).collect()
    assert sorted((r.n_chars, len(r.text)) for r in found) == [(0, 0), (0, 0), (3, 3), (len("\n".join(html.main_blocks(PAGE))),) * 2]
    assert [r.text for r in found if r.page_id is None] == ["a b"]


def labelled(n):
    rng = random.Random(2)
    syllables = "an re th ti on er es or ha wh nd st ing ed en ou".split()
    insults = "worthless pathetic disgusting idiot".split()
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(30, 150))]
        bad = i % 4 == 0
        if bad:
            for _ in range(len(words) // 10 + 2):
                words[rng.randrange(len(words))] = rng.choice(insults)
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_on_held_out_rows(spark):
    rows = labelled(800)
    docs = spark.createDataFrame([(i, t, -1.0) for i, t, _ in rows], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit_on(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    out = [(found[i], y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    right = sum(r.predicted == y for r, y in out)
    assert len(out) > 100 and right >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_labels_of_held_out_rows_are_not_used(spark):
    rows = labelled(200)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.fit_on(docs, labels) == toxicity.fit_on(docs, other)


def test_a_model_is_fitted_by_tasks(spark, monkeypatch):
    """The driver trains no dictionary and sees no text; the model is that of all rows together, also with few labels."""
    rows = [(i, t if i % 50 else None, y) for i, t, y in labelled(120)] + [(1000, "so few", 0)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(5)
    known = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5]

    def plain(ids):
        return toxicity.fit(sorted((t or "", y) for i, t, y in rows if i in ids))

    cases = [{i for i, _ in known}, {i for i, y in known if y}, {i for i, y in known if not y}, set()]
    wanted = [plain(ids) for ids in cases]
    monkeypatch.setattr(toxicity, "_trained", lambda *_: pytest.fail("trained in the driver"))
    monkeypatch.setattr(toxicity, "coded", lambda *_: pytest.fail("read in the driver"))
    for ids, want in zip(cases, wanted, strict=True):
        labels = spark.createDataFrame([k for k in known if k[0] in ids], "doc_id long, toxic int")
        assert toxicity.fit_on(docs, labels) == want


@pytest.mark.parametrize("rows, low, high", [([], 0.4, 0.6), ([("a", 0)], 0.0, 0.1), ([("a", 1)], 0.9, 1.0), ([("", 0), ("", 1)], 0.0, 1.0)])
def test_too_few_labels(rows, low, high):
    model = toxicity.fit(rows)
    scores = model.scores([None, "", "some words"])
    assert ((low <= scores) & (scores <= high)).all()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert toxicity.score(docs, toxicity.fit([])).collect() == []
    assert secrets.scan(docs).collect() == [] and html.extract(docs, "doc_id", "text").collect() == []


def test_toxicity_compresses_only_windows_with_toxic_wording(monkeypatch):
    """Of a long text with one toxic passage, the other windows save nothing and are not compressed."""
    plain = [(" ".join(f"word{(i * 7 + j) % 300}" for j in range(60)), 0) for i in range(40)]
    rude = [(" ".join(f"rude{(i + j) % 9}" for j in range(20)), 1) for i in range(20)]
    model = toxicity.fit(plain + rude)
    calls = []
    compressors = toxicity._compressors

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def compress(self, window):
            calls.append(window)
            return self.inner.compress(window)

    monkeypatch.setattr(toxicity, "_compressors", lambda *both: tuple(map(Counted, compressors(*both))))
    text = " ".join([plain[0][0]] * 20 + [rude[0][0]] + [plain[1][0]] * 20)
    found = toxicity.gains(text, model.ordinary, model.toxic)
    every = toxicity.windows(toxicity.coded(text))
    one, two = compressors(model.ordinary, model.toxic)
    assert len(found) == len(every) > 200
    assert found.tolist() == [len(one.compress(w)) - len(two.compress(w)) for w in every]
    assert found.max() > 0 and len(calls) < 20
    assert toxicity.gains("", model.ordinary, model.toxic).tolist() == [0]
    assert toxicity.gains(None, model.ordinary, b" ").tolist() == [0]
