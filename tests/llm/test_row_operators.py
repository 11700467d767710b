"""Secret scans, quality rules, language identification, URL templates, revisits and mixing against plain Python."""

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tripkit.llm import common, langid, mixing, queries, revisits, secret_scan, thresholds, url_templates

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, part string, row string"


def docs_frame(spark, rows):
    """Documents with extra columns whose names clash with those that operators use inside."""
    full = [(i, t, lang, src, None if t is None else len(t), "x", "y", "z") for i, t, lang, src in rows]
    return spark.createDataFrame(full, DOCS)


ODD = [
    (0, "", "en", "a"), (1, None, "en", "a"), (2, "one two\vthree\f four", None, None), (3, "word " * 60_000, "fr", "a"),
    (3, "word " * 60_000, "fr", "a"), (None, "x" * 3_000_000, None, "b"), (5, " \n\t ", "de", "b"), (6, "ß é \u00a0 日本", "de", "ä"),
]


def test_word_hashes_agree_with_split():
    texts = [b"a bb  a\nccc", b"", None, "é ü\u00a0x é".encode(), b"x" * 3_000_000 + b" y", b"A a"]
    words = common.hash_words(texts)
    split = [re.findall(rb"[^\x20\x09-\x0D]+", t or b"") for t in texts]
    assert list(np.diff(words.first)) == [len(s) for s in split]
    flat = [w for s in split for w in s]
    assert [bytes(words.buffer[a:b]) for a, b in zip(words.starts, words.ends)] == flat
    by_word = defaultdict(set)
    for w, h in zip(flat, words.hashes):
        by_word[w].add(int(h))
    assert all(len(v) == 1 for v in by_word.values()) and len(set().union(*by_word.values())) == len(by_word)
    lower = common.hash_words([b"A a"], lower=True)
    assert lower.hashes[0] == lower.hashes[1]


def naive_spans(text):
    assign = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [s for _, _, s in sorted(found)]


SECRETS = [
    "password=abc password = 12345678 PASSWD: 'aa.bb.cc.dd'", "AKIAAKIAAKIAAKIAAK AKIA1 akia", "f" * 31 + " " + "0" * 40 + "g",
    'token = "' + "ab12" * 10 + '" é AKIA' + "Z" * 12, "to\u212aen=12345678901 \u017fecret=123456789", "api_key:'12345678' apikey=87654321",
]


def test_secret_base_spans_are_those_of_the_patterns(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(SECRETS)] + [(90, None, "en", "a"), (91, "", "en", "a"), (92, "a=" * 50_000, "en", "a")]
    texts = {i: t for i, t, *_ in rows}
    got = secret_scan.scan_secrets(docs_frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = naive_spans(texts[r.doc_id] or "")
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(w.startswith(k) for w in want) for k in ("assign:", "access:", "hex:")]
        assert set(want) <= set(filter(None, r.spans.split(",")))


@pytest.mark.parametrize(
    "text, literal",
    [
        ('db_pwd = "tr0ub4dor&3x"', "tr0ub4dor&3x"),
        ("BASE = 'Zx81kQpw77'\nclientSecretValue = BASE", "Zx81kQpw77"),
        ('k = "aB3dE6gH"\nprivateKey := k + "9jKlMn0p"', "9jKlMn0p"),
        ('{"credentials": "q9W8e7R6t5Y4"}', "q9W8e7R6t5Y4"),
        ("signing_key: q9W8e7R6t5Y4u3", "q9W8e7R6t5Y4u3"),
    ],
)
def test_literals_reach_sensitive_names(text, literal):
    at = text.index(literal)
    assert (at, at + len(literal), "literal") in secret_scan.all_spans(text)[1]
    assert literal not in secret_scan.redact(text)


@pytest.mark.parametrize("text", ['title = "q9W8e7R6t5Y4"', "pwd = changeme", "pwd = ${DB_PASSWORD}", "auth == q9W8e7R6t5Y4", "the key: is here"])
def test_plain_text_has_no_spans(text):
    assert secret_scan.all_spans(text)[1] == []


def test_redaction_keeps_rows_and_columns(spark):
    docs = docs_frame(spark, [(1, "pass word password=12345678 end", "en", "a"), (2, None, "en", "a"), (3, "clean", "en", "a")])
    out = {r.doc_id: r for r in secret_scan.redact_secrets(docs).collect()}
    assert out[1].text == "pass word <secret> end" and out[1].n_chars == len(out[1].text)
    assert out[2].text is None and out[3].text == "clean" and out[3].n_chars == 5


def naive_counts(text):
    words = re.findall(common.WORD, text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if re.search(common.WORD, line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)


def test_quality_counts(spark):
    real = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    rows = [(r.doc_id + 100, r.text, r.lang, r.source) for r in real] + [r for r in ODD if r[0] is not None]
    texts = {i: t for i, t, *_ in rows}
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = thresholds.judge_quality(spark, docs_frame(spark, rows), labels).collect()
    assert len(got) == len(rows)
    for r in got:
        want = naive_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 50 or 100 * want[4] > 50 * want[0]
        assert (r.base_failed, r.kept) == (failed, not failed)


def test_binomial_tail_and_cutoff():
    for n, p in ((10, 0.3), (200, 0.01), (3000, 0.5)):
        for x in (0, n // 10, n // 3, n // 2, n):
            exact = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(x + 1)) if n < 1000 else None
            if exact is not None:
                assert thresholds.binomial_tail(x, n, p) == pytest.approx(exact, abs=1e-9)
    values = np.array([0, 1, 2, 50, 60])
    good, bad = np.array([900, 90, 9, 1, 0]), np.array([0, 0, 0, 40, 60])
    assert thresholds.choose_cutoff(values, good, bad, 0.01, 0.01) == 49
    assert thresholds.choose_cutoff(values, good // 30, bad, 0.01, 0.01) is None  # too few good texts to prove anything
    assert thresholds.choose_cutoff(values, good, good, 0.01, 0.01) is None


def test_false_rejections_stay_below_the_limit(spark):
    rows, labels = [], []
    for i in range(3000):
        junk = i % 4 == 0
        words = [f"w{i}x{k}" + ("$$$" if junk else "") for k in range(60)]
        rows.append((i, " ".join(words), ["en", "fr"][i % 2] if i % 7 else None, "a"))
        if i % 3:
            labels.append((i, 0 if junk else 1, 0))
    labels += [(None, 1, 0), (1, None, None), (10**9, 1, 1), labels[0]]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = thresholds.judge_quality(spark, docs_frame(spark, rows), frame, max_false_rejection=0.2).collect()
    assert len(got) == 3000
    assert all(r.kept for r in got if r.doc_id % 4)
    rejected = [r for r in got if not r.kept]
    assert len(rejected) > 600 and all("symbol_rate" in r.rejected_by for r in rejected)


def test_language_accuracy_and_odd_rows(spark):
    got = queries.QUERIES["op6_identify_language"](spark, "/root/testdata/sf0.01").collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)
    train = docs_frame(spark, [(0, "hello the thing", "en", "a"), (1, "öde grüße", "de", "a"), (2, None, "xx", "a"), (3, "zzz", None, "a")])
    prototypes = langid.learn_prototypes(train)
    assert list(prototypes) == ["de", "en"]
    odd = {(r.doc_id, i): r for i, r in enumerate(langid.predict_language(docs_frame(spark, ODD), prototypes).collect())}
    assert len(odd) == len(ODD)
    for r in odd.values():
        assert r.lang_pred == ("und" if r.doc_id in (0, 1, 5) else r.lang_pred) and (r.lang_pred != "und" or r.score == 0)
    nothing = langid.learn_prototypes(train.limit(0))
    assert nothing == {} and {r.lang_pred for r in langid.predict_language(train, nothing).collect()} == {"und"}


def test_bundles_are_sums_of_bound_letter_vectors():
    grams = langid.Grams(["abab", None, "1a"], 3, 64)
    vector = lambda s: math.prod(np.roll(langid.letter_vector(ord(c) if c != " " else 0, 64).astype(int), 2 - i) for i, c in enumerate(s))
    want = sum(vector(s) for s in (" ab", "aba", "bab", "ab "))
    assert np.array_equal(grams.bundles()[0], want)
    assert not grams.bundles()[1].any() and np.array_equal(grams.bundles()[2], vector(" a "))


def test_judging_holds_few_texts_at_a_time():
    """Neither many short texts nor some MB of long ones are held at once; answers come in the order of the texts."""
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(400)]
    short = [" ".join(rng.choice(words, 3)).encode() for _ in range(10_000)]
    long = [" ".join(rng.choice(words, 5_000)).encode() for _ in range(100)]
    judge = langid._judge({"a": rng.normal(size=2048), "b": rng.normal(size=2048)}, 3, True)
    judge(pd.Series([b"warm"]))
    for texts in (short, long):
        tracemalloc.start()
        got = judge(pd.Series(texts, index=range(7, 7 + len(texts))))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 130 << 20
        assert list(got.index) == list(range(7, 7 + len(texts)))
        for i in (0, len(texts) // 2, len(texts) - 1):
            assert judge(pd.Series([texts[i]])).iloc[0].to_dict() == pytest.approx(got.iloc[i].to_dict())


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def naive_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, _ in RULES:
        at, tail = rule.split("/", 1)
        if (host == at or host.endswith("." + at)) and path.startswith("/" + tail):
            fits.append(rule)
    return host, path, max(fits, key=len) if fits else None


def test_url_rules(spark):
    urls = [
        None, "", "no scheme", "http://a.NET/x?y", "HTTP://EXAMPLE.net/en/1#f", "x://example.net/en", "http://net", "http://net/", "http://anet/",
        "http://m.example.com/de/", "http://example.com/fr?://b.net/", "http://b.org/fr/é\nz", "http://a.org?x=/fr/", "http://É.Net/q", "://net/a",
    ]
    pages = spark.createDataFrame([(i, u, "h", "b", "t") for i, u in enumerate(urls * 2)], "page_id long, url string, host string, bad string, template string")
    labels = spark.createDataFrame([], "page_id long, bad int")
    got = url_templates.judge_urls(spark, pages, RULES, labels).collect()
    assert len(got) == len(pages.collect())
    for r in got:
        host, path, rule = naive_rule((urls * 2)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (dict(RULES)[rule] if rule else "allow")
    assert url_templates.judge_urls(spark, pages.limit(0), RULES, labels).count() == 0


def test_templates_split_only_where_labels_differ(spark):
    rows, marks = [], []
    for i in range(400):
        section = ["news", "casino", "blog", "shop"][i % 4]
        rows.append((i, f"http://h.example.com/{section}/{i}.html"))
        marks.append((i, 1 if section == "casino" else int(i % 50 == 0)))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(marks, "page_id long, bad int")
    got = url_templates.judge_urls(spark, pages, RULES, labels).collect()
    assert {r.template for r in got} == {"/casino/*", "/*/*"}
    assert all((r.verdict == "block") == ("casino" in r.path) for r in got)
    many = spark.createDataFrame([(i, f"http://h.example.com/u{chr(97 + i % 26)}{chr(97 + i // 26)}q/x") for i in range(300)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad int")
    assert {r.template for r in url_templates.judge_urls(spark, many, RULES, none).collect()} == {"/*/*"}


def test_a_bad_branch_among_many_siblings_is_found(spark):
    """Sixty clean sections, hundreds of pages seen once, and one section whose labels are all bad."""
    sections = [f"s{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["casino"]
    paths = [f"{name}/{i}.html" for name in sections for i in range(40)]
    paths += [f"u{chr(97 + k % 26)}{chr(97 + k // 26)}q/x" for k in range(400)]
    pages = spark.createDataFrame([(i, f"http://h.example.com/{path}") for i, path in enumerate(paths)], "page_id long, url string")
    marks = [(i, int("casino" in path or i % 97 == 0)) for i, path in enumerate(paths)]
    got = url_templates.judge_urls(spark, pages, RULES, spark.createDataFrame(marks, "page_id long, bad int")).collect()
    assert {r.template for r in got} == {"/casino/*", "/*/*"}
    assert all((r.verdict == "block") == ("casino" in r.path) for r in got)


def test_revisits(spark):
    head = "record_id long, record_type string, url string, time long, headers map<string,string>, digest string, found string, stored string"
    R = lambda i, kind, url, t, headers, digest=None: (i, kind, url, t, headers, digest, "x", "y")
    records = spark.createDataFrame([
        R(1, "response", "http://A.com:80/x/?b=1&a=2&utm_source=q#f", 10, {"ETag": '"v1"', "Content-Length": "9", "X": "1"}, "d1"),
        R(2, "response", "https://a.com/x?a=2&b=1", 20, {"etag": '"v2"', "Last-Modified": "m"}, "d2"),
        R(3, "response", "http://a.com/x?a=2&b=1", 20, {"etag": '"v3"'}, None),
        R(4, "revisit", "http://a.com/x?a=2&b=1", 20, {"ETAG": 'W/"v1"', "content-length": "0", "x": "2", "Y": "3", "Connection": "y"}),
        R(5, "revisit", "http://a.com/x?a=2&b=1", 21, {"etag": '"v3"'}),
        R(6, "revisit", "http://a.com/x?a=2&b=1", 21, {"etag": '"v2"'}),
        R(7, "revisit", "http://a.com/x?a=2&b=1", 10, None),
        R(8, "revisit", None, 30, {}), R(9, "revisit", "http://a.com/x?a=2&b=1", None, {}),
        R(10, "revisit", "http://a.com/x?a=2&b=1", 30, None), R(11, "revisit", "http://a.com/x?a=2&b=1", 30, None, "zz"),
        R(12, "metadata", "http://a.com/x", 30, None), R(5, "revisit", "http://a.com/x?a=2&b=1", 21, {"etag": '"v3"'}),
    ], head)
    got = defaultdict(list)
    for r in revisits.resolve_revisits(records).collect():
        got[r.record_id].append(r)
    assert {k: (v[0].outcome, v[0].response_id) for k, v in got.items()} == {
        4: ("resolved", 1), 5: ("resolved", 3), 6: ("validator_mismatch", None), 7: ("no_earlier_response", None), 8: ("no_earlier_response", None),
        9: ("no_earlier_response", None), 10: ("validator_mismatch", None), 11: ("resolved", 3),
    }
    assert len(got[5]) == 2
    assert got[4][0].merged_headers == {"etag": 'W/"v1"', "content-length": "9", "x": "2"}
    assert revisits.resolve_revisits(records.limit(0)).count() == 0


def test_revisits_of_one_hot_url(spark):
    n = 4000
    rows = [(i, ["response", "revisit"][i * 7 % 3 == 0], "http://a.b/" + ("" if i % 5 else str(i % 50)), i * 37 % n, {"etag": "e"}, None) for i in range(n)]
    frame = spark.createDataFrame(rows, "record_id long, record_type string, url string, time long, headers map<string,string>, digest string")
    seen = defaultdict(list)
    for i, kind, url, t, *_ in rows:
        if kind == "response":
            seen[url].append((t, i))
    for r in revisits.resolve_revisits(frame).collect():
        url = rows[r.record_id][2]
        earlier = [x for x in seen[url] if x[0] < r.time]
        assert r.response_id == (max(earlier)[1] if earlier else None)


def test_targets_and_takes(spark):
    rows = [(i, "w " * (i % 9), "en", ["big", "big", "s1", "s2", None][i % 5]) for i in range(500)]
    rows += [(1000, "w " * 300, "en", "one"), (1001, None, "en", "empty"), (1002, "w " * 8, "en", "big"), (1002, "w " * 8, "en", "big")]
    frame = docs_frame(spark, rows)
    pieces, listed = mixing.mix_sources(spark, frame)
    pieces, listed = pieces.collect(), listed.collect()
    assert len(listed) == len(rows)
    taken, by_source, target = Counter(), Counter(), {r.source: r.target for r in listed}
    for p in pieces:
        taken[p.row] += p.to_word - p.from_word
        by_source[p.source] += p.to_word - p.from_word
    total = sum(r.size for r in listed)
    sizes = Counter()
    for r in listed:
        sizes[r.source] += r.size
        assert taken[r.row] <= 2 * r.size
    names = sorted(filter(None, sizes), key=lambda s: [ord(c) for c in s]) + [None]
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, want = 1.5 * total, set(names), {}
    while True:  # share, cut and share again
        over = {s for s in open_ if left * weights[s] / sum(weights[x] for x in open_) >= 2 * sizes[s]}
        if not over:
            break
        want |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        open_ -= over
    want |= {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
    assert target == pytest.approx(want)
    assert all(abs(by_source[s] - want[s]) < 1 for s in names)
    order = sorted(pieces, key=lambda p: p.mixed_before)
    assert [p.finish for p in order] == sorted(p.finish for p in order)
    assert order[-1].mixed_before + order[-1].to_word - order[-1].from_word == sum(math.floor(t) for t in want.values())
    again, _ = mixing.mix_sources(spark, frame)
    assert sorted(map(tuple, again.drop("row").collect())) == sorted((*p[:3], *p[4:]) for p in pieces)


def test_mixed_texts_and_empty_tables(spark):
    frame = docs_frame(spark, [(1, "a b  c", "en", "s"), (2, "d e", "en", "t"), (2, "d e", "en", "t"), (3, None, "en", "t")])
    pieces, _ = mixing.mix_sources(spark, frame)
    out = mixing.mixed_texts(frame, pieces)
    assert out.columns == frame.columns
    assert sum(len(r.text.split()) for r in out.collect()) == pieces.agg(F.sum(F.col("to_word") - F.col("from_word"))).first()[0]
    pieces, listed = mixing.mix_sources(spark, frame.limit(0))
    assert pieces.count() == listed.count() == 0
    pieces, listed = mixing.mix_sources(spark, frame.filter("text is null"))
    assert pieces.count() == 0 and listed.first().target == 0


def test_hostile_assignments_are_scanned_in_bounded_work():
    import time

    start = time.time()
    doubling = 'a = "q7Zr9Lx2Wk"\n' + "a = a + a\n" * 2000 + "password = a\n"
    base, spans = secret_scan.all_spans(doubling)
    assert [s for s in spans if s[2] == "literal"] == [(5, 15, "literal")]
    growing = "".join(f'k = k + "v{i}Xy{i * 7919}"\n' for i in range(20_000)) + "api_secret = k\n"
    assert len(secret_scan.all_spans('k = "seed0Seed"\n' + growing)[1]) == 20_001
    many = "".join(f'token_{i} = "Ab3{i:06d}xYz"\npassword: hunter{i:06d}x\n' for i in range(50_000))
    base, spans = secret_scan.all_spans(many)
    assert len(base) == 50_000 and len(spans) == 100_000
    assert time.time() - start < 60


def test_values_are_scored_as_their_joined_text():
    def plain(value):
        if len(value) < 8 or secret_scan.PLACEHOLDER.match(value) or any(c.isspace() for c in value):
            return 0.0
        share = [n / len(value) for n in Counter(value).values()]
        kinds = sum(bool(re.search(p, value)) for p in ("[a-z]", "[A-Z]", r"\d", r"[^A-Za-z0-9]"))
        return min(1.0, -sum(p * math.log2(p) for p in share) / 4) * (0.4 if kinds == 1 else 0.8 if kinds == 2 else 1.0)

    for parts in (["abc", "DEF9", "$$x"], ["change", "_me"], ["xxxx", "xxxx"], ["a b", "c12345678"], ["short"], ["q7Zr9Lx2Wk"] * 40):
        value = secret_scan.Value([(p, 0, len(p)) for p in parts])
        nested = secret_scan.Value([secret_scan.Value([(p, 0, len(p))]) for p in parts])
        assert value.score() == nested.score() == pytest.approx(plain("".join(parts)), abs=1e-12)
