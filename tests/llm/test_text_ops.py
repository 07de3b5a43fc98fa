import hashlib
import itertools
import math
import random
import re
import struct
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerflow.llm import bpe, chat, langid, licenses, lzprint, mainhtml, tokencount
from tests.conftest import SF_SMALL
from tests.llm.conftest import messy_rows, prose


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec()


@pytest.fixture(scope="module")
def tik(codec):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=codec.whole, special_tokens={})


def ids_of(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


@settings(deadline=None, max_examples=150)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=200))
def test_bpe_equals_the_rank_file_library(codec, tik, text):
    packed = codec.encode(text)
    assert ids_of(packed) == tik.encode_ordinary(text)
    assert codec.decode(packed) == text.encode()


@pytest.mark.parametrize("text", ["", "a" * 5000, "ab" * 3000, "\n\n  \t x  ", "<|endoftext|>", "⁇ <unk>", "é\u0000\u00a0"])
def test_bpe_special_texts(codec, tik, text):
    assert ids_of(codec.encode(text)) == tik.encode_ordinary(text)


def test_bpe_on_messy_rows(messy, tik):
    got = sorted((str(r.doc_id), bytes(r.ids), bytes(r.decoded)) for r in bpe.encode_decode(messy).collect())
    want = sorted((str(d), struct.pack(f"<{len(x)}I", *x), (t or "").encode()) for d, t, _ in messy_rows() for x in [tik.encode_ordinary(t or "")])
    assert got == want
    assert bpe.encode_decode(messy.limit(0)).count() == 0


def test_bpe_query_digests(spark, tik):
    got = {r.doc_id: r for r in bpe.digests(spark, SF_SMALL).collect()}
    table = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()
    assert len(got) == len(table)
    for r in table:
        ids = tik.encode_ordinary(r["text"] or "")
        g = got[r["doc_id"]]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256) == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())


def brute_tokens(raw, scores):
    """Best (score, fewest tokens) over all segmentations, by position."""
    best = [(0, 0)] + [None] * len(raw)
    for e in range(1, len(raw) + 1):
        best[e] = max((best[s][0] + scores[raw[s:e]], best[s][1] - 1) for s in range(e) if raw[s:e] in scores)
    return best[-1]


def test_token_counts_equal_brute_force(messy):
    scores = tokencount.token_scores(tokencount.VOCABULARY)
    cut = regex.compile(tokencount.PATTERN).findall
    want = []
    for d, t, _ in messy_rows():
        parts = [brute_tokens(p.encode(), scores) for p in cut((t or "")[:3000])]
        want.append((str(d), -sum(n for _, n in parts), sum(s for s, _ in parts) / tokencount.UNIT))
    from pyspark.sql import functions as F
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in tokencount.counts(messy.withColumn("text", F.substring("text", 1, 3000))).collect())
    assert got == sorted(want)


def test_token_counts_do_not_depend_on_what_the_trie_holds(monkeypatch):
    words = [prose(i, 30).split(" ") for i in range(20)]
    fresh = [tokencount.Trie(tokencount.token_scores(tokencount.VOCABULARY)).measure(words[0])]
    monkeypatch.setattr(tokencount, "NODES", 10)
    t = tokencount.Trie(tokencount.token_scores(tokencount.VOCABULARY))
    assert [t.measure(w) for w in words][0] == fresh[0] == t.measure(words[0])


def test_lz_fingerprints_and_neighbours(messy):
    rows = sorted(((d, t or "") for d, t, _ in messy_rows()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1], strict=True):
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        own, other, after = map(lzprint.print_of, (t, edited, nxt))
        want.append((str(d), len(t), hashlib.sha256(edited.encode()).hexdigest(), lzprint.fingerprint(own), lzprint.fingerprint(other), lzprint.likeness(own, other), lzprint.likeness(own, after)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in lzprint.neighbours(messy).collect()]
    assert sorted(got) == sorted(want)
    assert lzprint.neighbours(messy.limit(0)).count() == 0
    one = lzprint.neighbours(messy.where("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def plain_phrases(text: str) -> set[str]:
    """The phrase set by slices and a set, and what the end cuts short."""
    seen, start = set(), 0
    while start < len(text):
        end = start + 1
        while text[start:end] in seen and end < len(text):
            end += 1
        seen.add(text[start:end])
        start = end
    return seen


def plain_print(text: str) -> str:
    """The fingerprint by whole numbers, one phrase after another."""
    m, base = 1 << 64, 0x9E3779B97F4A7C15

    def mix(x: int) -> int:
        for _ in range(2):
            x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % m
        return x ^ x >> 32

    hashes = {mix((sum(mix(ord(c) + 1) * pow(base, i, m) for i, c in enumerate(w)) + len(w)) % m) >> 32 for w in plain_phrases(text)}
    return "".join(f"{x:08x}" for x in sorted(hashes)[:lzprint.SIZE])


def edge_texts() -> list[str]:
    return ["", "a", "aa", "aaab", "a" * 500, "ab" * 77, "日本語日本語日本" * 9, "\U0001F600é\x00" * 5, prose(3, 300), prose(3, 299) + "x", *[prose(i, i) for i in range(1, 40, 3)]]


def test_lz_fingerprints_equal_plain_ones(monkeypatch):
    texts = edge_texts()
    for run in (lzprint.RUN, 7):  # texts beyond a run
        monkeypatch.setattr(lzprint, "RUN", run)
        for t, nxt in zip(texts, texts[1:] + texts[:1], strict=True):
            own, edited, other = lzprint.prints_of_both(t, nxt)
            assert edited == t[:len(t) - len(t) // 4] + nxt[:len(t) // 4]
            assert (lzprint.fingerprint(own), lzprint.fingerprint(other)) == (plain_print(t), plain_print(edited))


def test_lz_likeness_follows_the_phrase_sets():
    a, b = prose(1, 900), prose(1, 600) + prose(9, 300)
    sets = [plain_phrases(t) for t in (a, b)]
    assert abs(lzprint.likeness(lzprint.print_of(a), lzprint.print_of(b)) - len(sets[0] & sets[1]) / len(sets[0] | sets[1])) < 0.2
    assert lzprint.print_of("") .size == 0 and lzprint.likeness(lzprint.print_of(""), lzprint.print_of(a)) == 0


PAGES = [
    ("<html><body><nav><a href=1>menu</a></nav><article><h1>T &amp; t</h1><p>One  two\n three<br>four<p>five <b>si</b>x</article><footer>f</footer>", "T & t\nOne two three four\nfive six"),
    ("<body><div class='main'><p>Long enough text of the page, it goes on and on.</p><p>Short.</p></div><div class='sidebar'>side</div><div id=comments>bad</div>", "Long enough text of the page, it goes on and on.\nShort."),
    ("<body><article><p>a</p><!-- no <p>x</p> --><script>if (a < b) '</p>'</script><style>p{}</style><form><input></form><div class='ad box'>buy</div><p>b</p>", "a\nb"),
    ("<article><p>&lt;b&gt; &eacute;&#233;&#x1F600;</p><ul><li><a>x</a></li><li><a>y</a></li></ul><ul><li>one<li>two</ul><p>cut <b", "<b> éé\U0001F600\none\ntwo\ncut"),
    ("no markup at all", "no markup at all"), ("", ""), (None, ""), ("<!-- never closed", ""), ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"), ("<div>" * 5000 + "deep", "deep"),
]


def test_main_text_of_pages(spark):
    rows = [(i, f"u{i}", p, "x") for i, (p, _) in enumerate(PAGES)] + [(None, None, PAGES[0][0], "x")]
    got = {r.page_id: r for r in mainhtml.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert got[None].text == PAGES[0][1] and got[None].url is None


def test_main_text_of_the_whole_table(spark):
    import html
    table = pq.read_table(f"{SF_SMALL}/pages.parquet").to_pylist()
    got = {r.page_id: r.text for r in mainhtml.pages(spark, SF_SMALL).collect()}
    for r in table:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner.replace("<br>", " ")))
        assert got[r["page_id"]] == "\n".join(b for b in blocks if b)


def test_density_prefers_text_to_links():
    root = mainhtml.parse("<body><div><p>" + "word " * 80 + "</p></div><div>" + "<a href=x>link text here</a>" * 10 + "</div>")
    _, order = mainhtml.measure(root)
    text, links = [x for x in order if x.tag == "div"]
    assert text.density > 5 * links.density


TEXT = "Some sentence of the main text that goes on for a while, and then on. " * 4


@pytest.mark.parametrize("page", [
    "<body><div class='content has-sidebar'><p>{t}</p><p>{t}</p></div><div class='sidebar'>side</div>",
    "<body><div id=page class='no-sidebar'><p>{t}</p><p>{t}</p></div>",
    "<body><div class='post social-share-enabled'><p>{t}</p><p>{t}</p></div>",
    "<body><div class='left-sidebar'><div class='text'><p>{t}</p><p>{t}</p></div></div>",
    "<body><div class=comments><p>{t}</p><p>{t}</p></div>",
    "<body><article><section id='related-work'><p>{t}</p></section><p>{t}</p></article>",
    "<body><article><div class='text widget'><p>{t}</p><p>{t}</p></div></article><div class=promoted>" + "<p>{t}</p>" * 9 + "</div>",
    "<body><article><p>{t}</p><p class='notice'>{t}</p></article>",
    "<body><article><p>{t}</p><p>{t}</p></article><div id=comments>" + "<p>{t}</p>" * 9 + "</div>",
    "<body><div class=post><p>{t}</p><p>{t}</p></div><div id=comments>" + "<div><p>{t}</p></div>" * 9 + "</div>",
])
def test_class_words_do_not_cut_what_holds_the_text(page):
    assert mainhtml.main_text(page.replace("{t}", TEXT)) == "\n".join([TEXT.strip()] * 2)


def test_thresholds_decide_on_pages_without_article():
    """Beside the way to the body, a dense subtree is kept and those of links or scraps are not."""
    links = "".join(f"<a href=x>link {i}</a> " for i in range(8))
    page = f"<body><div><b>x</b>{links}</div><div><div><p>{TEXT}</p><p>{TEXT}</p><p>{TEXT}</p></div><p>{TEXT}</p><div>{links}</div></div><div><i>a</i><i>b</i><i>c</i></div>"
    root = mainhtml.parse(page)
    kept = mainhtml.content(root)
    assert [x.tag for x in kept] == ["div", "p"] and len(kept[0].children) == 3
    assert mainhtml.main_text(page) == "\n".join([TEXT.strip()] * 4)


def test_references_of_an_article_are_kept():
    refs = [f"On the {w} of long titles in lists of references" for w in ("use", "harm", "length")]
    page = f"<body><article><p>{TEXT}</p><ol>" + "".join(f"<li><a href=x>{x}</a></li>" for x in refs) + "</ol><ul><li><a>Home</a></li><li><a>Next</a></li></ul></article>"
    assert mainhtml.main_text(page) == "\n".join([TEXT.strip(), *refs])


def brute_places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    at = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())
    return len(words), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))


def test_license_places_equal_brute_force(spark, tmp_path):
    mit = next(iter(licenses.NOTICES))
    worn = mit.replace("free of charge", "entirely free of any charge")
    rows = [(d, t) for d, t, _ in messy_rows()] + [(50, "cc by nc cc by nc by nc CC-BY-NC!"), (51, prose(1, 20) + " " + mit), (52, worn), (53, mit[:60]), (54, "under the mit\u0000license under the MIT\n license"), (None, "cc by nc")]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as pos", "'x' as label", "0 as uid").write.parquet(f"{tmp_path}/documents.parquet")
    got = licenses.documents(spark, str(tmp_path)).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got))) == sorted(map(str, ((d, *brute_places(t)) for d, t in rows)))
    labels = {r.doc_id: r.labels for r in got}
    assert labels[51] == "mit" and labels[52] == "mit" and labels[53] == "" and labels[12] == "apache-2,cc-by-nc,mit"
    assert all(0 <= r.score <= 1 and bool(r.score) == bool(r.labels) for r in got)


def test_licenses_of_an_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_language_accuracy_on_held_out_rows(spark):
    lang = {r["doc_id"]: r["lang"] for r in pq.read_table(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet").to_pylist()}
    got = [r for r in langid.languages(spark, SF_SMALL.replace("0.001", "0.01")).collect()]
    held = [r for r in got if r.held_out]
    assert len(got) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_language_edge_cases(messy):
    got = {(r.doc_id, r.text): r.found for r in langid.identified(messy.drop("found")).collect()}
    assert len(got) == len({r[:2] for r in messy_rows()})
    for (_, text), found in got.items():
        if not any(map(str.isalpha, text or "")):
            assert (found.lang_pred, found.score) == ("und", 0.0)
    empty = langid.Model([], np.zeros((0, langid.SLOTS)))
    assert empty.predict("text") == ("und", 0.0, True)
    single = langid.Model(["xx"], np.ones((1, langid.SLOTS)))
    assert single.predict("text") == ("xx", 1.0, False) and single.predict("12") == ("und", 0.0, True)


@pytest.mark.parametrize("n", [2, 4, 6, 7, 30, 200])
def test_codewords_are_apart(n):
    code = langid.codewords(n)
    apart = min((a != b).sum() for a, b in itertools.combinations(code, 2))
    assert apart >= (1 if n == 2 else max(2, code.shape[1] // 5)) and (abs(code.sum(0)) < n).all()


@pytest.mark.parametrize("run", [1, 2, 3, 7, 100])
def test_long_texts_have_the_same_features_in_runs(monkeypatch, run):
    texts = [prose(3, 400), "a", "", "a  b..c 1 d", "..ab", "ÉÀ日本 x", "\U0001F600a"]
    whole = [langid.features(t) for t in texts]
    monkeypatch.setattr(langid, "RUN", run)
    for t, w in zip(texts, whole, strict=True):
        assert (langid.features(t) == w).all()


def plain_features(text: str) -> dict[int, int]:
    """Counts by slot, gram by gram, with whole numbers."""
    m = 1 << 64
    codes = [ord(c) if c.isalpha() else 0 for c in text.lower()]
    codes = [c for i, c in enumerate(codes) if c or not i or codes[i - 1]]
    out = {}
    for n in langid.ORDERS:
        for i in range(len(codes) - n + 1):
            gram = codes[i:i + n]
            if n > 1 or gram[0]:
                h = 0
                for c in gram:
                    h = (h * 0x9E3779B97F4A7C15 + c + 1) % m
                x = (h + n) % m
                for _ in range(2):
                    x = (x ^ x >> 32) * 0xD6E8FEB86659FD93 % m
                slot = (x ^ x >> 32) >> 64 - int(math.log2(langid.SLOTS))
                out[slot] = out.get(slot, 0) + 1
    return out


def test_decoding_equals_a_plain_one():
    """Margins, losses and the choice, one bit and codeword after another."""
    samples = {f"l{i}": plain_features(prose(i, 60) + " " + "xyz"[i % 3] * 5) for i in range(5)}
    names = sorted(samples)
    counts = np.zeros((len(names), langid.SLOTS), np.int64)
    for i, x in enumerate(names):
        for slot, n in samples[x].items():
            counts[i, slot] = n
    model = langid.Model(names, counts)
    code = langid.codewords(len(names)).tolist()
    p = [[(c + langid.SMOOTHING) / (sum(row) + langid.SMOOTHING * langid.SLOTS) for c in row] for row in counts.tolist()]
    for text in (prose(2, 9), "xxxxx yy", prose(77, 3), "a"):
        found = plain_features(text)
        assert found == {i: n for i, n in enumerate(langid.features(text).tolist()) if n}
        loss, trusts = [0.0] * len(names), 0.0
        for bit in range(len(code[0])):
            side = [i for i in range(len(names)) if code[i][bit] > 0]
            rest = [i for i in range(len(names)) if code[i][bit] < 0]
            ratio = [math.log(sum(p[i][s] for i in side) / len(side)) - math.log(sum(p[i][s] for i in rest) / len(rest)) for s in range(langid.SLOTS)]
            each = [code[i][bit] * sum(a * b for a, b in zip(p[i], ratio, strict=True)) for i in range(len(names))]
            scale = sum(each) / len(each)
            trust = max(min(each) / scale, 0.05)
            margin = sum(n * ratio[s] for s, n in found.items()) / max(1, sum(found.values())) / scale
            loss = [x + trust * math.log1p(math.exp(-2 * code[i][bit] * margin)) for i, x in enumerate(loss)]
            trusts += trust
        loss = [x / trusts for x in loss]
        best = min(range(len(names)), key=loss.__getitem__)
        share = [math.exp(-langid.SHARPNESS * (x - loss[best])) for x in loss]
        lang, score, ambiguous = model.predict(text)
        assert lang == names[best] and score == pytest.approx(share[best] / sum(share), rel=1e-3)
        assert ambiguous == (sorted(loss)[1] - loss[best] < langid.LEAD) or abs(sorted(loss)[1] - loss[best] - langid.LEAD) < 1e-4


def test_hostile_pages_are_parsed_in_linear_time():
    import time
    pages = ["<div>" * 20_000 + "</span>" * 20_000, "<span>" * 20_000 + "<p>x" * 20_000, "<ul><li>" + "<b>" * 20_000 + "</li><ul>" * 10_000, "<p><x-a>" + "<i>" * 20_000 + "<div></div>" * 20_000]
    began = time.process_time()
    for page in pages:
        mainhtml.parse(page)
    assert time.process_time() - began < 10


def chat_want(turns):
    sha = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), sha, len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_read_back(spark, tmp_path):
    hard = [r"\### Assistant: </turn> ok", "### </turn>\n\\", "a:\nb", "", "\\\\<\\/turn>", "### ### x</turn></turn>", "é\U0001F600"]
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "odd:\nrole", "### x", None]), r.choice([*hard, None])) for c in range(12) for t in range(r.choice([1, 2, 9, 300]))]
    rows += [(40, 0, "user", "tie"), (40, 0, "assistant", "tie"), (40, 0, "user", "tie"), (41, None, "user", "x"), (41, 5, "assistant", "y")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as tree", "2 as node", "3 as score", "4 as path").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {x.conv_id: x for x in chat.conversations(spark, str(tmp_path)).collect()}
    by = {-7: [("user", hard[0]), ("assistant", hard[0])]}
    for c, _, role, text in sorted(rows, key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] or "", x[3] or "")):
        by.setdefault(c, []).append((role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == chat_want(turns), c


def test_reply_trees_choose_branches(spark):
    rows = [(1, 1, None, "user", "root", 0.0), (1, 2, 1, "assistant", "good", 2.0), (1, 3, 1, "assistant", "bad", 1.0), (1, 4, 3, "user", "late", 1.0), (1, 5, 2, "user", "end", 0.5),
            (1, 9, 99, "user", "lost parent", 0.0), (None, 1, None, "user", "null tree", None), (2, 1, 2, "a", "cycle", 0.0), (2, 2, 1, "b", "cycle", 0.0), (1, 5, 2, "zz", "repeated id", 0.5)]
    trees = spark.createDataFrame(rows, "tree long, node long, parent long, role string, text string, score double")
    best = {(r.tree, r.path, r.place): r.text for r in chat.chosen_paths(trees).collect()}
    assert best == {(1, 5, 1): "root", (1, 5, 2): "good", (1, 5, 3): "end", (1, 9, 1): "lost parent", (None, 1, 1): "null tree"}
    every = {(r.path, r.rank) for r in chat.chosen_paths(trees, keep=None).where("tree = 1").collect()}
    assert every == {(5, 1), (4, 2), (9, 1)}
    assert chat.chosen_paths(trees.limit(0)).count() == 0


def test_escaping_is_reversible(spark):
    texts = ["\\", "</turn>", "### ", "\\</turn>", "x\\### </turn", "", "##### \\\\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for t, e in df.select("t", chat.escape(df.t).alias("e")).collect():
        assert chat.unescape(e) == t
        assert not re.search(r"(?<!\\)(?:\\\\)*(</turn>|### )", "x" + e) or "\\" in e


def test_conversations_equal_sql(spark):
    from ledgerflow.llm import queries
    from tools.oracle_check import compare, duck
    df = chat.conversations(spark, SF_SMALL)
    cur = duck(SF_SMALL).execute(queries.ORACLES["op5_reply_trees"])
    rows = df.collect()
    assert any(r.conv_id == -7 and r.n_turns == 2 for r in rows)
    assert compare(rows, df.columns, cur.fetchall(), [d[0] for d in cur.description]) is None
