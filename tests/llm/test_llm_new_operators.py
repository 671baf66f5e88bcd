"""URL filter, periodic runs and token alignment against brute force, with nulls, repeats and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import alignment, periodic_runs, url_filter
from salescast.llm.common import stage

DOCS = "doc_id long, text string, lang string, source string, n_chars long, `TEXT` string, pair long, n_a long"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- periodic runs ----------------------------------------------------------------------------

def brute_runs(words):
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def brute_document(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str("" if doc_id is None else doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    top = (None,) * 4 if best is None else (
        best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2])
    ordered = sorted((s, e - s, q) for s, e, q in runs)
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in sorted(ordered, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_of_random_sequences():
    rng = random.Random(4)
    for _ in range(600):
        kinds, n = rng.choice([1, 2, 2, 3, 5, 20]), rng.randint(1, 70)
        words = [rng.randrange(kinds) for _ in range(n)]
        if rng.random() < 0.6:
            p, a = rng.randint(1, 8), rng.randrange(n)
            for i in range(a + p, min(n, a + p * rng.randint(3, 12))):
                words[i] = words[i - p]
        assert periodic_runs.runs_of(np.array(words, np.int64)) == brute_runs(words)


def test_long_periodic_sequences():
    key = np.concatenate([np.zeros(40_000, np.int64), np.arange(1, 900)])
    assert periodic_runs.runs_of(key) == [(0, 40_000, 1)]
    key = np.concatenate([np.arange(3000)] * 9 + [np.arange(1700)])
    assert periodic_runs.runs_of(key) == [(0, len(key), 3000)]


def run_texts():
    rng = random.Random(8)
    vocabulary = ["a", "b", "the", "of", "é", "語"] + [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    texts += ["x " * 9, "a b " * 7 + "a", "A\tb\x0bA b\x0cA\rb A\nb A b", "u\x85u u u u u u u u u u", "ha ha ha ha ha", "ha " * 6]
    texts += [t * 5 for t in texts[:10]] + [None, "", "  \t", texts[3], " ".join(f"n{i}" for i in range(4000)) * 6]
    return texts


def test_documents_equal_brute_force(spark):
    texts = run_texts()
    # Ids whose tail is made periodic as well as others.
    ids = [i for i in range(4000) if zlib.crc32(str(i).encode()) % 10 == 0][: len(texts) // 2] + list(range(len(texts)))
    pairs = [(ids[k], t) for k, t in enumerate(texts)]
    pairs += [pairs[5], (None, texts[2]), (None, "x " * 30)]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "clash", 1, 2) for i, t in pairs], DOCS).repartition(3)
    got = rows_of(periodic_runs.find_runs(df))
    short = [p for p in pairs if len(p[1] or "") < 50_000]
    expected = [brute_document(i, t) for i, t in short]
    assert len(got) == len(pairs) and any(r[1] for r in got)
    assert not Counter(expected) - Counter(got)


def test_runs_of_no_documents(spark):
    assert periodic_runs.find_runs(spark.createDataFrame([], DOCS)).count() == 0


# -- token alignment --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tool():
    return alignment.Aligner()


def brute_alignment(tool, text):
    """Whole text under both tokenizers, every pair of tokens looked at."""
    none = (0, 0, 0, 0, "", Counter())
    if not text:
        return none
    data = (" " + text).encode()
    a, b = tool.a.encode(" " + text, add_special_tokens=False).ids, tool.b.encode(text)
    parts = [tool.bytes_a[i] for i in a], [tool.bytes_b[i] for i in b]
    if any(b"".join(p) != data for p in parts):
        return none

    def spans(pieces):
        at = 0
        for p in pieces:
            yield at, at + len(p)
            at += len(p)

    spans_a, spans_b = list(spans(parts[0])), list(spans(parts[1]))
    links = Counter((i, j) for i, (s, e) in zip(a, spans_a) for j, (u, v) in zip(b, spans_b) if s < v and u < e)
    cuts = sorted({e for _, e in spans_a} & {e for _, e in spans_b})
    groups, low = [], 0
    for cut in cuts:
        groups.append(",".join(str(i) for i, (s, _) in zip(a, spans_a) if low <= s < cut) + "|" + ",".join(
            str(j) for j, (s, _) in zip(b, spans_b) if low <= s < cut))
        low = cut
    return len(a), len(b), len(cuts), sum(links.values()), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def token_texts():
    rng = random.Random(5)
    letters = "ab Z'é́ \n\t cd 09.,!<|>語ﬁ  🙂s t"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    return texts + [None, "", " ", "  ", " lead", "tail ", "a  b   c ", "x" * 500, "<|endoftext|> it's", "a▁b", "▁", "\x00a b", "<s> </s> <unk>",
                    "don't   stop\r\n\r\n now", "word " * 600]


def test_texts_equal_brute_force(tool):
    texts = [t or "" for t in token_texts()]
    small = alignment.Aligner(memo=50)
    for t, m, again in zip(texts, tool.measure(texts), (small.measure([t]) for t in texts)):
        whole = brute_alignment(tool, t)
        pairs = Counter({(int(p) >> 24, int(p) & (1 << 24) - 1): int(k) for p, k in zip(m[5], m[6])})
        assert (*m[:5], pairs) == whole, t
        assert next(again)[:5] == m[:5]


def test_alignment_equals_brute_force(spark, tool):
    texts = token_texts()[-220:]
    pairs = list(enumerate(texts)) + [(1000 + i, "the same old text") for i in range(300)] + [(7, texts[7]), (None, "the same")]
    df = spark.createDataFrame([(i, t, "en", "s", 0, "clash", 1, 2) for i, t in pairs], DOCS).repartition(3)
    whole = [(i, brute_alignment(tool, t)) for i, t in pairs]
    counts = Counter(p for _, m in whole for p in m[5])
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    expected = sorted(((
        i, *m[:4], sum(k for p, k in m[5].items() if counts[p] == highest[p[0]]), sum(k * counts[p] for p, k in m[5].items()), m[4])
        for i, m in whole), key=repr)
    assert rows_of(alignment.align(df)) == expected
    aligned = alignment.aligned_texts(df)
    assert {(r["id_a"], r["id_b"]): r["n"] for r in alignment.pair_counts(aligned).collect()} == dict(counts)
    assert aligned.count() < len(pairs) - 290  # equal texts are aligned once
    assert alignment.align(spark.createDataFrame([], DOCS)).count() == 0


# -- URL filter -------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, `URL` string, id long, score int, verdict string, w string"


def page_urls():
    rng = random.Random(6)
    hosts = ["blog.example.org", "example.org", "EXAMPLE.org", "myexample.org", "a.b.com", "com", "x.net", "x.net:80", "org", "free-bets.com"]
    tails = ["", "/", "/es/1", "/en/12", "/en/2", "/fr/a", "/de/b?x=/fr/", "/fr", "/es/?q", "#/fr/", "?u=http://a.org/"]
    urls = [f"{rng.choice(['http', 'https', 'FTP'])}://{rng.choice(hosts)}{rng.choice(tails)}{rng.choice(['', str(rng.randrange(99))])}"
            for _ in range(300)]
    return urls + [None, "", "no scheme", "://", "http://", "http://org/://com/fr/", "é://ü.org/ñ", "http://x.net/" + "long/" * 3000,
                   "http://x.com/de/\nb", *["https://hot.net/en/5"] * 150]


def brute_urls(urls):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    out, train, held = {}, {"allow": set(), "block": set()}, {}
    for url in {u or "" for u in urls}:
        rest = url.split("://", 1)[1] if "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, None))
        out[url] = [host, path, rule, verdict]
        is_held = hashlib.md5(url.encode()).hexdigest()[0] in "0123"
        if verdict and not is_held:
            train[verdict].add(url)
        elif verdict:
            held[url] = verdict
    counts = {v: defaultdict(Counter) for v in train}
    for v, members in train.items():
        for url in members:
            padded = "\x01" * 5 + url
            for i in range(5, len(padded)):
                for k in range(6):
                    counts[v][padded[i - k : i]][padded[i]] += 1

    def chance(v, before, c):
        p = 1 / 256
        for k in range(6):
            seen = counts[v].get(before[5 - k :])
            if seen:
                p = (seen[c] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    def score(url):
        padded = "\x01" * 5 + url
        total = 0
        for i in range(5, len(padded)):
            x = (math.log(chance("allow", padded[i - 5 : i], padded[i])) - math.log(chance("block", padded[i - 5 : i], padded[i]))) * 1e6
            total += math.copysign(math.floor(abs(x) + 0.5), x)
        return max(-2000, min(2000, math.floor(total / max(len(url), 1) / 10_000)))

    told = {u: score(u) for u in out if out[u][3] is None or u in held}
    good, bad = ([told[u] for u, v in held.items() if v == side] for side in ("allow", "block"))
    cut = min(set(good + bad), key=lambda t: (-sum(s >= t for s in good) * len(bad) - sum(s < t for s in bad) * len(good), t)) if good and bad else 0
    return {u: (h, p, r, v or ("allow" if told[u] >= cut else "block"), told.get(u)) for u, (h, p, r, v) in out.items()}


def test_urls_equal_brute_force(spark):
    urls = page_urls()
    df = spark.createDataFrame([(i, u, "x", "clash", 1, 2, "v", "w") for i, u in enumerate(urls)] + [(None, urls[0], None, None, None, None, None, None)], PAGES)
    found = brute_urls(urls)
    expected = sorted(((i, *found[u or ""]) for i, u in [*enumerate(urls), (None, urls[0])]), key=repr)
    got = rows_of(url_filter.judge(df.repartition(3)))
    assert got == expected
    open_verdicts = {r[4] for r in got if r[3] is None}
    assert open_verdicts == {"allow", "block"}


def test_urls_without_rules_or_rows(spark):
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0
    df = spark.createDataFrame([(1, "http://x.net/a", None), (2, "http://x.net/a", None), (3, None, None)], "page_id long, url string, html string")
    assert rows_of(url_filter.judge(df)) == [(1, "x.net", "/a", None, "allow", 0), (2, "x.net", "/a", None, "allow", 0), (3, "", "", None, "allow", 0)]
    one_sided = spark.createDataFrame([(i, f"http://a.org/{i}", None) for i in range(9)] + [(9, "http://b.net/", None)], "page_id long, url string, html string")
    assert url_filter.judge(one_sided).where("verdict = 'allow'").count() >= 9


def test_url_tables_that_grow_are_not_sent_through_the_driver(spark):
    urls = [(i, u, v, i % 4 == 0) for i, (u, v) in enumerate(zip((u for u in page_urls() if u), ["allow", "block", None] * 999))]
    df = spark.createDataFrame(urls, "id long, url string, verdict string, held boolean")
    grams, contexts = (stage(t, "test") for t in url_filter.character_counts(df.where("verdict is not null")))
    wanted = df.select(F.explode(url_filter.windows(F.col("url"))).alias("w")).distinct()
    ratios = url_filter.log_ratios(wanted, grams, contexts)
    scored = url_filter.scores(df, stage(ratios, "test"))
    judged = url_filter.judge(spark.createDataFrame([(0, "http://a.org/", None)], "page_id long, url string, html string"))
    for frame, keys in ((ratios, "cg"), (scored, "w"), (judged, ["id"])):
        joins = [x.split("Join [")[1] for x in frame._jdf.queryExecution().executedPlan().toString().splitlines() if "SortMergeJoin [" in x]
        assert all(any(x.startswith(f"{key}#") for x in joins) for key in keys)
    assert ratios.count() == wanted.count() and scored.count() == len(urls)
