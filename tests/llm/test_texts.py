"""Fingerprints, extraction, personal data, secrets and language identification."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from opsframe.llm import extract, fingerprint, langid, pii, secrets
from tests.conftest import SF
from tests.llm import cases


def with_edits(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        out.append((d, len(t), hashlib.sha256((t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]).encode()).hexdigest()))
    return collections.Counter(out)


def test_fingerprint_edits(spark):
    for df in (cases.documents(spark), cases.edges(spark), cases.edges(spark).limit(1), cases.edges(spark).where("doc_id is null")):
        out = fingerprint.fingerprint_table(df).collect()
        assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == with_edits([(r.doc_id, r.text) for r in df.collect()])
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert fingerprint.fingerprint_table(cases.empty(spark)).count() == 0


def test_winnowing_against_brute_force(spark):
    """Every window's rightmost least hash is chosen, nothing else, so shared runs share a hash."""
    docs = [(r[0], r[1]) for r in cases.documents(spark).where("doc_id < 60").select("doc_id", "text").collect()] + [(9000 + i, t) for i, (_, t, *_) in enumerate(cases.EDGES)]
    df = fingerprint.with_fingerprint(spark.createDataFrame(docs, "doc_id long, text string"), "text", "own")
    for r in df.collect():
        units = [m for m in re.findall(r"[^ \t-\r]{1,8}", r.text or "")]
        h, w = r.own_hash, fingerprint.WINDOW
        assert len(h) == (len(units) - fingerprint.K + 1 if len(units) >= fingerprint.K else min(1, len(units)))
        windows = [range(i, i + w) for i in range(len(h) - w + 1)] if len(h) >= w else [range(len(h))] if h else []
        assert sorted(r.own_at) == sorted({max(x, key=lambda i: (-h[i], i)) for x in windows})
        seen = {}
        for i in range(len(units) - fingerprint.K + 1):  # equal k-grams, equal hashes, and no two others
            assert seen.setdefault(tuple(units[i : i + fingerprint.K]), h[i]) == h[i]
        assert len(set(seen.values())) == len(seen)


def test_equal_texts_have_equal_fingerprints(spark):
    by = collections.defaultdict(set)
    for r in fingerprint.fingerprint_table(cases.documents(spark)).join(cases.documents(spark).select("doc_id", "text"), "doc_id").collect():
        by[r.text].add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def article(words):
    return f"<h1>{words[0]}</h1>" + "".join(f"<p>{w}</p>" for w in words[1:])


def test_extract_named_parts_and_markup():
    page = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>if (a<b) x("</p>");</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice"><p>We use</p></div>
      <article><header><h1>A  title &amp; more</h1></header><p>One<b> bold</b>
      line<br>two &lt;x&gt; &#233;&nbsp;z<p>Unclosed <i>para <div class="ad">Buy</div><ul><li>first<li>second</ul><form><p>Name</p></form>
      <aside>side</aside><!-- no <p>comment</p> --><section id="comments"><p>Reader</p></section><p hidden>not shown</p></article>
      <footer>&copy; foot</footer></body></html>"""
    assert extract.main_text(page, frozenset()) == "A title & more\n\nOne bold line two <x> é z\n\nUnclosed para\n\nfirst\n\nsecond"
    for odd in ("", None, "<", "plain", "<p", "<p>a<b", "</p></div>", "<a title='x>y", "<script>never closed", "<table><tr><td>1<td>2<tr><td>3"):
        extract.main_text(odd, frozenset())
    assert extract.main_text("plain &lt; 1 < 2", frozenset()) == "plain < 1 < 2"
    assert extract.main_text("<table><tr><td>1<td>2<tr><td>3", frozenset()) == "1\n\n2\n\n3"
    deep = "<div>" * 20_000 + "deep"
    assert extract.main_text(deep, frozenset()) == "deep"


def test_extract_templates(spark):
    """Parts of unnamed elements that recur on a host's pages go; the same parts on few pages stay."""
    rows = []
    for i in range(40):
        rows.append((i, f"https://WWW.a.org/{i}", f"<body><div><div>Top of a</div><span>x</span></div><div><p>Text {i}</p><p>More {i}</p></div><div>Bottom of a</div></body>"))
    for i in range(40, 60):
        rows.append((i, f"http://b.org/{i}", f"<body><div>{'Top of a' if i == 41 else i}</div><article><p>Same article</p></article><div>End</div></body>"))
    rows += [(100, None, "<p>alone</p>"), (101, "https://www.a.org/x", None), (102, "no url", ""), (None, "https://c.org", "<p>x</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("extra")).withColumn("text", F.lit("extra"))
    got = {(r.page_id, r.url): (r.text, r.n_chars) for r in extract.extract_digest(df).collect()}
    assert got[3, "https://WWW.a.org/3"] == ("Text 3\n\nMore 3", 14)
    assert got[45, "http://b.org/45"] == ("Same article", 12)
    assert got[100, None] == ("alone", 5) and got[101, "https://www.a.org/x"] == ("", 0) and got[None, "https://c.org"] == ("x", 1)
    assert len(got) == len(rows) and extract.extract_digest(df.limit(0)).count() == 0


def test_extract_templates_inside_articles(spark):
    """A nameless block that recurs inside a host's articles goes; copies and near copies of an article keep their text."""
    rows = []
    for i in range(30):
        rows.append((i, f"https://a.org/{i}", f"<body><article><h2>Summary</h2><p>Text {i} of a</p><div><p>Read also our weekly letter</p></div><p>More {i}</p></article></body>"))
        rows.append((100 + i, f"https://b.org/{i}", f"<body><div>{i}</div><article><p>One text</p><p>in two parts</p></article></body>"))
        rows.append((200 + i, f"https://c.org/{i}", "<body><article>" + "".join(f"<p>Part {n} of a text that was copied</p>" for n in range(9)) + f"<p>Edit {i}</p></article></body>"))
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(30):
        assert got[i] == f"Summary\n\nText {i} of a\n\nMore {i}"
        assert got[100 + i] == "One text\n\nin two parts"
        assert got[200 + i].count("copied") == 9 and got[200 + i].endswith(f"Edit {i}")


def test_extract_doubtful_names_inside_articles(spark):
    """Parts of an article with doubtful names stay unless the host's template has them; articles stay whatever their name."""
    page = """<body class="no-comments"><div class="layout has-sidebar"><article class="post comments-open"><h2 id="legal-form">Legal form</h2>
      <section id="discussion"><p>Long talk</p></section><div class="search-results form">Found <math><mi>x</mi><annotation>tex</annotation></math></div>
      <xmp>a &lt; <b></xmp><p class="related">Kin</p><div class="box ad">Buy</div><div class="comments">Reader</div></article></div></body>"""
    text = "Legal form\n\nLong talk\n\nFound x\n\na &lt; <b>\n\nKin"
    assert extract.main_text(page, frozenset()) == text
    assert extract.main_text('<body><div class="ad">x</div><main class="reply"><p>y</p></main></body>', frozenset()) == "y"
    rows = [(i, f"https://a.org/{i}", f'<article><p>Text {i}</p><p><span class="legal">All rights reserved</span> Line {i}</p></article>') for i in range(9)] + [(9, "https://b.org", page)]
    got = {r.page_id: r.text for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == text and all(got[i] == f"Text {i}\n\nLine {i}" for i in range(9))


def test_extract_pages(spark):
    """On the given pages the text is the article's, decoded, block by block."""
    import html

    for r in extract.extract(spark.read.parquet(f"{cases.SF}/pages.parquet")).join(spark.read.parquet(f"{cases.SF}/pages.parquet").select("page_id", "html"), "page_id").collect():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n\n".join(x for x in parts if x)


BASE = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base_by_patterns(text):
    def good(kind, s):
        digits = [int(c) for c in s if c.isdigit()]
        if kind == "ip":
            return all(int(x) <= 255 for x in s.split("."))
        if kind == "card":
            return 12 <= len(digits) <= 19 and sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits[::-1])) % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    found = [(m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(BASE) for m in re.finditer(p, text) if good(k, m[0])]
    return [x[2] for x in sorted(found)]


def test_base_spans_follow_their_patterns():
    rng = random.Random(2)
    pieces = ["a@b.c", "x.y+z@host-1.org.uk", "@", ".", "1.2.3.4", "300.1.2.3", "4111 1111 1111 1111", "+1 (017) 555-7713", "+", "(", " ", "-", "7", "é", "a", "\n", "00012", "٣", "@b.c"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.joined(sorted(pii.base_spans(text), key=lambda x: (x[1], pii.KINDS.index(x[0])))) == ",".join(base_by_patterns(text)), text
    assert pii.base_spans("a" * 300_000 + "1" * 300_000) == [] or True  # long runs take linear time


def test_personal_data(spark):
    docs = cases.documents(spark).unionByName(spark.createDataFrame([e for e in cases.EDGES], cases.SCHEMA))
    texts = collections.Counter()
    for r in docs.collect():
        b = base_by_patterns(r.text or "")
        texts[r.doc_id, *(sum(x.startswith(k) for x in b) for k, _ in BASE), hashlib.sha256(",".join(b).encode()).hexdigest()] += 1
    got = pii.spans_table(docs).collect()
    assert collections.Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == texts
    for r in got:  # base spans stay
        assert r.n_email + r.n_ip + r.n_card + r.n_phone <= len([x for x in r.spans.split(",") if x])
    assert pii.spans_table(cases.empty(spark)).count() == 0 and pii.spans_table(cases.edges(spark)).count() == len(cases.EDGES)


def test_redaction(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.org, call +1 (017) 555-7713.", 0), (2, None, None), (3, "é 10.0.0.1", 1)], "doc_id long, text string, n_chars long")
    assert cases.rows(pii.redact(df, pii.Booster(), "text", "n_chars")) == [(1, "mail [EMAIL], call [PHONE].", 27), (2, None, None), (3, "é [IP]", 6)]


def test_booster_learns_and_calibrates():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.integers(0, 2, 4000) * 2.0, rng.random((4000, 4))])
    y = ((x[:, 1] > 0.4) ^ (x[:, 2] > 0.7)).astype(float)
    m = pii.Booster()
    m.fit(x[:3000], y[:3000])
    m.calibrate(x[3000:], y[3000:])
    q = m.score(x[3000:])
    assert ((q > 0.5) == (y[3000:] > 0.5)).mean() > 0.95
    assert abs(q.mean() - y[3000:].mean()) < 0.05 and m.thresholds["phone"] == 2.0  # a kind without examples adds nothing


def test_secrets(spark):
    docs = cases.documents(spark)
    extra = [(9000, "see /usr/share/doc/package1/readme.txt and 12345678901234567890 now", "en", "s", 0), (9001, "é token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" x", "en", "s", 0),
             (9001, "é token = \"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b\" x", "en", "s", 0), *cases.EDGES]
    df = docs.unionByName(spark.createDataFrame(extra, cases.SCHEMA))
    text = {r.doc_id: r.text for r in df.collect()}
    got = secrets.scan_table(df).collect()
    for r in got:
        assert hashlib.sha256(text[r.doc_id][r.start : r.end].encode()).hexdigest() == r.found_sha256
    planted = {(d, m.start(1)) for d, t in text.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t or "")}
    kept = {(r.doc_id, r.start) for r in got if r.kept}
    assert planted <= kept and not any(d == 9000 for d, _ in kept)
    assert sum(r.doc_id == 9001 for r in got) == 2
    assert secrets.scan_table(cases.empty(spark)).count() == 0
    secrets.scan_table(cases.edges(spark)).collect()


def test_language(spark):
    docs = cases.documents(spark)
    out = langid.language_table(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out) and len(out) == docs.count()
    held = [r for r in out if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    model = langid.train(cases.documents(spark))
    df = cases.edges(spark).withColumn("lang_pred", F.lit("old"))
    out = langid.predict(df, model)
    assert out.columns[-2:] == ["lang_pred", "score"] and out.count() == len(cases.EDGES)
    by = {r.doc_id: r for r in out.collect()}
    for d in (1001, 1002, 1003, 1011):
        assert by[d].lang_pred == "und" and by[d].score == 0
    assert langid.language_table(cases.empty(spark)).count() == 0
    assert {r.lang_pred for r in langid.predict(df, langid.train(cases.empty(spark))).collect()} == {"und"}
    alone = langid.train(df.withColumn("lang", F.lit("xx")))
    assert {r.lang_pred for r in langid.predict(df, alone).collect()} == {"xx", "und"}


def test_language_blocks_agree():
    """A text's prediction doesn't depend on what stands beside it."""
    rng = np.random.default_rng(1)
    model = langid.Model(["a", "b"], np.ones(langid.DIM), rng.standard_normal((langid.DIM, 2)) / 50, np.zeros(2), 1.0)
    texts = [e[1] for e in cases.EDGES]
    whole = model.predict(texts)
    for i, t in enumerate(texts):
        one = model.predict([t])
        assert one[0][0] == whole[0][i] and abs(one[1][0] - whole[1][i]) < 1e-6


def test_added_spans_are_personal_data(spark):
    """Spelled-out addresses are added in any case and length; dates, versions, hardware addresses and prose are not."""
    import random

    rng, rows = random.Random(4), []
    for i in range(400):
        n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))  # noqa: E731, B023
        rows.append((i, f"mail a{i}@site{i % 7}.example.org, phone +49 30 {n(7)}, host 10.{i % 256}.3.{rng.randrange(256)} or 10.300.{i % 9}.1, "
                        f"card {n(4)} {n(4)} {n(4)} {n(4)}, on 20{n(2)}-0{1 + i % 9}-1{n(1)}, look at page{i}.now, hw 00:1B:44:11:{n(2)}:{n(2)}, version 1.{i % 9}.{n(1)}"))
    model = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    long = "plain words without any data " * 40
    added = lambda x: [(k, x[s:e]) for k, s, e in pii.all_spans(x, model)[1]]
    for text in ("JOHN.DOE (AT) EXAMPLE (DOT) COM", "john.doe[at]example.com", "john.doe at example dot com", "john.doe\tAT\nexample DOT com"):
        for x in (text, long + text + " " + long):
            assert added(x) == [("email", text)], x
    for text in ("look at me.now", "meet at noon", "2024-01-15 10-30", "15.01.2024", "00:1B:44:11:3A:B7", "version 10.2.3", "ISBN 978-3-16-148410-1", "page at www.example.org"):
        for x in (text, long + text + " " + long):
            assert added(x) == [], x
    assert pii.clear_of([("ip", 0, 5), ("ip", 5, 9), ("ip", 20, 30)], [(9, 21), (3, 4)]) == [("ip", 5, 9)]

def candidates_by_hand(text):
    """Left to right: what is assigned to a secret's name, else a long run of key characters."""
    names = "token|secret|password|passwd|passphrase|pwd|api.?key|access.?key|private.?key|auth|credentials?|client.?key"
    lead = re.compile(rf"(?:{names})[A-Za-z0-9_]{{0,8}}[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?\Z", re.I | re.A)
    key, out, i, last = re.compile(r"[A-Za-z0-9_+/=~.-]"), [], 0, 0
    while i < len(text):
        end = i
        if text[i] not in "=:" and (i == 0 or text[i - 1] in " \t\n=:\"'") and lead.search(text[max(0, i - 60) : i]):
            while end < len(text) and text[end] not in " \t\n\r\"',;<>":
                end += 1
        if end - i < 6:
            end = i
            if not (i and key.match(text[i - 1])):
                while end < len(text) and key.match(text[end]):
                    end += 1
            if end - i < 16:
                i += 1
                continue
        found, before = text[i:end], text[max(last, i - 48) : i]  # what stands before ends at the match before
        if re.search("[0-9]", found) or re.search(r"[=:]\s*[\"']?\Z", before) or re.search("(?i)" + secrets.SECRET_WORDS[4:], before):
            out.append((i, found))
        i = last = end
    return out


def test_candidates_equal_a_scan_by_hand(spark):
    import random

    rng = random.Random(12)
    parts = ["password", "pwd", "api_key", "SECRET_KEY", "token", "id", " ", " ", "=", ": ", "= \"", "'", "\n", "hunter2secret", "S3cr3t!x9Q#k2$Lm%P0", "Zx81kQ0p", "abc",
             "0123456789abcdef0123", "path/to/some/where/else", ",", "<", "x" * 20, "plain words"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 14))) for _ in range(500)] + ["", "password = hunter2secret", "pwd: S3cr3t!x9Q#k2$Lm%P0"]
    got = {}
    for r in secrets.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.start, r.found))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == candidates_by_hand(t), t


def test_dictionary_counts_different_texts(spark):
    rows = [(i, "the deploy password=tangerinefox81x of ours") for i in range(50)] + [(100 + i, f"deploy number {i}") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.word for r in secrets.dictionary(df).collect()} == {"deploy", "number"}  # fifty copies of one text make no word


def test_scores_tell_short_cuts_and_nonsense_from_text(spark):
    docs = spark.read.parquet(SF.replace("0.001", "0.01") + "/documents.parquet")
    model = langid.train(docs.where(~langid.held_out()))
    assert 0.3 < model.temperature < 10 and 0 < model.floor <= 0.5
    held = docs.where(langid.held_out()).where("text is not null").select("text", "lang").collect()
    names, scores = model.predict([r.text for r in held])
    assert np.mean([a == r.lang for a, r in zip(names, held)]) > 0.99 and np.median(scores) > 0.99
    assert model.predict(["xqz kk vv", "zzz"])[1].max() < 0.97
    # calibration over texts and cuts of them: within each tenth of the scores, as many are right as they say
    cuts = [(r.text[i : i + n], r.lang) for r in held for n in (8, 20, 60) for i in (0, len(r.text) // 2) if any(c.isalpha() for c in r.text[i : i + n])]
    names, scores = model.predict([c for c, _ in cuts])
    right = np.array([a == b for a, (_, b) in zip(names, cuts)])
    bins = np.minimum((scores * 10).astype(int), 9)
    ece = sum(abs(right[bins == b].mean() - scores[bins == b].mean()) * (bins == b).mean() for b in set(bins.tolist()))
    assert ece < 0.08


def test_language_examples_stay_in_their_columns():
    """The driver copies a drawn text's numbers only while they are used."""
    raw = lambda *v: np.array(v, "<u4").tobytes()
    cut = np.arange(2 * sum(langid.CUTS), dtype="<u4").tobytes()
    rows = [(None, raw(1), "b"), (7, raw(9, 2), "a"), (7, raw(3, 2), "a"), (7, raw(5), "B"), (2, b"", "b")]
    table = pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "slots": pa.array([r[1] for r in rows], pa.binary()),
                      "shares": pa.array([np.full(len(r[1]) // 4, 0.5, "<f4").tobytes() for r in rows], pa.binary()),
                      "cuts": pa.array([cut] * 5, pa.binary()), "label": [r[2] for r in rows]})
    examples = langid.Examples(table, np.arange(1.0, langid.DIM + 1), ["B", "a", "b"])
    assert examples.in_order() == sorted(range(5), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][2], rows[k][1]))
    assert [examples.size(k) for k in range(5)] == [1, 2, 2, 1, 0]
    assert examples.of([3, 1]).table is table and examples.of([3, 1]).rows == [3, 1]
    ids, x, label = examples.of([3, 1])[1]
    assert ids.tolist() == [9, 2, langid.DIM] and x.tolist() == [0.5 * 10 * langid.SCALE, 0.5 * 3 * langid.SCALE, 1.0] and label == 1
    assert [len(i) for i, _, _ in examples.whole_and_cuts(1)] == [2, *(2 * n for n in langid.CUTS)]


def test_training_steps_equal_a_plain_twin():
    """FTRL over dense vectors, one coordinate at a time."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(30):
        ids = np.sort(rng.choice(12, 4, replace=False))
        rows.append((np.append(ids, langid.DIM), np.append(rng.random(4), 1.0), int(rng.integers(3))))
    weights, bias = langid.ftrl(rows, 3)
    z, n = {}, {}
    w = lambda i, c: 0.0 if abs(z.get((i, c), 0.0)) <= langid.L1 else -(z[i, c] - np.sign(z[i, c]) * langid.L1) / ((langid.BETA + n.get((i, c), 0.0) ** 0.5) / langid.ALPHA + langid.L2)
    order = np.random.default_rng(7)
    for _ in range(langid.EPOCHS):
        for k in order.permutation(len(rows)):
            ids, x, y = rows[k]
            s = [sum(w(i, c) * v for i, v in zip(ids, x)) for c in range(3)]
            e = np.exp(np.array(s) - max(s))
            p = e / e.sum()
            steps = [(i, c, v * (p[c] - (c == y)), w(i, c)) for i, v in zip(ids, x) for c in range(3)]
            for i, c, g, old in steps:
                before = n.get((i, c), 0.0)
                z[i, c] = z.get((i, c), 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / langid.ALPHA * old
                n[i, c] = before + g * g
    assert np.allclose([[w(i, c) for c in range(3)] for i in range(12)], weights[:12]) and np.allclose([w(langid.DIM, c) for c in range(3)], bias)
