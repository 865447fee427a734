"""Pre-tokens, prefix BPE and token counts against the public libraries."""

import hashlib
import random

import pyarrow as pa
import pytest

from llm.conftest import collected, empty_of
from marquee.llm.bpe import PrefixBpe, PrefixTable, decode_documents, encode_documents, read_ranks
from marquee.llm.pretokens import SliceEncoder, model_encoder
from marquee.llm.textbytes import slices
from marquee.llm.token_counts import RULES, token_counts

ODD = "aZ '\n\t sdtmrevl'1.!é　\x1c\x85 ٣漢²\U0001F600\r\x0b\x00"


def random_texts(seed, n=3000, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, most))) for _ in range(n)]


def encoded(encoder, texts, size=1 << 12):
    out = []
    for i, j, offsets, data in slices(pa.array(texts, pa.string()), size):
        ids, ends = encoder(offsets, data)
        out += [ids[ends[k]:ends[k + 1]].tolist() for k in range(j - i)]
    return out


@pytest.fixture(scope="module")
def bpe(vocabulary):
    return PrefixBpe(read_ranks(vocabulary("byte_bpe_50k.tiktoken")))


def test_slices_of_random_texts_equal_the_library(vocabulary, tik):
    texts = random_texts(1)
    # A tiny cache and pool: replacing and emptying must not matter.
    for options in ({}, {"bits": 4, "pool": 300}):
        encoder = SliceEncoder(model_encoder(vocabulary("byte_bpe_50k.json")), **options)
        assert encoded(encoder, texts) == [tik.encode_ordinary(t) for t in texts]


def test_prefix_bpe_equals_the_library(bpe, tik, documents):
    texts = random_texts(2) + [t[:3000] for _, t in documents[0][:60]] + ["a" * 500, " " * 300, "<|endoftext|>", "zq" * 200]
    assert encoded(SliceEncoder(lambda words: [bpe.encode(w) for w in words]), texts) == [
        tik.encode_ordinary(t) for t in texts]


def test_every_prefix_has_its_own_encoding(bpe):
    data = "internationalisation'sÉé".encode()
    table = PrefixTable(bpe, data)
    for n in range(len(data) + 1):
        assert table.ids(n) == PrefixTable(bpe, data[:n]).ids()
        assert bpe.decode(table.ids(n)) == data[:n]


def test_appends_and_edits_are_exact_and_local(bpe):
    rng = random.Random(3)
    letters = b"abcdeing the rst"
    for _ in range(60):
        data = bytes(rng.choice(letters) for _ in range(rng.randint(0, 400)))
        table = PrefixTable(bpe, data[:100])
        table.append(data[100:])
        assert table.last == PrefixTable(bpe, data).last
        a = rng.randint(0, len(data))
        b = min(len(data), a + rng.randint(0, 5))
        new = bytes(rng.choice(letters) for _ in range(rng.randint(0, 5)))
        computed = table.replace(a, b, new)
        fresh = PrefixTable(bpe, data[:a] + new + data[b:])
        assert (table.data, table.last) == (fresh.data, fresh.last)
        assert computed <= len(fresh.last) - a
    long = bytes(rng.choice(letters) for _ in range(5000))
    table = PrefixTable(bpe, long)
    assert table.replace(2000, 2001, b"x") < 600


ENCODED = ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def expected(rows, tik):
    out = []
    for doc, text in rows:
        ids = tik.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=repr)


def test_documents_equal_the_library(documents, vocabulary, tik):
    rows, frame = documents
    path = vocabulary("byte_bpe_50k.tiktoken")
    got = encode_documents(frame, path, with_ids=True)
    assert collected(got, *ENCODED) == expected(rows, tik)
    assert collected(decode_documents(got, path), "doc_id", "text") == sorted(rows, key=repr)


def test_odd_rows_and_empty_table(odd_rows, vocabulary, tik):
    path = vocabulary("byte_bpe_50k.tiktoken")
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    assert collected(encode_documents(odd_rows, path), *ENCODED) == expected(rows, tik)
    assert encode_documents(empty_of(odd_rows), path).collect() == []


# --- token counts ------------------------------------------------------------------

COUNTS = ("doc_id", "section", "start", "end", "n_tokens", "n_crossing")


def attributed(text, sections, offsets, rule):
    """Counts by comparing every token with every section."""
    count, crossing = {-1: 0}, {-1: 0}
    for k in range(len(sections)):
        count[k] = crossing[k] = 0
    for a, b in offsets:
        shared = {k: min(b, e) - max(a, s) for k, (s, e) in enumerate(sections) if min(b, e) > max(a, s)}
        pick = -1
        if shared:
            pick = {"first": min(shared), "last": max(shared),
                    "most": min(shared, key=lambda k: (-shared[k], k))}[rule]
        count[pick] += 1
        crossing[pick] += bool(shared) and not (sections[pick][0] <= a and b <= sections[pick][1])
    return count, crossing


def brute_counts(rows, path, rule, sections_of):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(path)
    spans = {}
    out = []
    for doc, text in rows:
        text = text or ""
        sections = sections_of(text)
        # Spans by bytes of the tokens: a token inside a character covers that character.
        raw = text.encode()
        char = [k for k, c in enumerate(text) for _ in c.encode()]
        at, offsets = 0, []
        for i in tokenizer.encode(text, add_special_tokens=False).ids:
            n = spans.setdefault(i, len(tokenizer.id_to_token(i)))  # the added token is ASCII: a letter is a byte
            offsets.append((char[at], char[at + n - 1] + 1))
            at += n
        assert at == len(raw)
        count, crossing = attributed(text, sections, offsets, rule)
        out += [(doc, k, *sections[k], count[k], crossing[k]) for k in range(len(sections))]
        if count[-1]:
            out.append((doc, -1, 0, 0, count[-1], 0))
    return sorted(out, key=repr)


def line_sections(text):
    cuts = [0, *(k + 1 for k, c in enumerate(text) if c == "\n"), len(text)]
    return list(zip(cuts, cuts[1:]))


def test_lines_equal_brute_force(spark, documents, vocabulary):
    rows, frame = documents
    path = vocabulary("byte_bpe_50k.json")
    short = [(d, t[:2500]) for d, t in rows[:80]] + [(1000 + k, t) for k, t in enumerate(random_texts(5, 60))]
    short += [(2000, "a <|endoftext|>\n b"), (2001, "<|endoftext|><|endoftext|>\n"), (2002, "<|endo"), (2003, "ftext|>")]
    df = spark.createDataFrame(short, "doc_id long, text string")
    for rule in RULES:
        assert collected(token_counts(df, path, rule), *COUNTS) == brute_counts(short, path, rule, line_sections)


def test_given_sections_equal_brute_force(spark, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    rng, rows = random.Random(8), []
    for k, t in enumerate(random_texts(6, 80, 60) + ["internationalisation of words"] * 20):
        cuts = sorted(rng.choices(range(len(t) + 1), k=2 * rng.randint(0, 4)))
        rows.append((k, t, list(zip(cuts[::2], cuts[1::2]))))
    of = {t: s for _, t, s in rows}
    rows = [(k, t, of[t]) for k, t, _ in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, s array<struct<start:long,end:long>>")
    for rule in RULES:
        expected_ = brute_counts([r[:2] for r in rows], path, rule, lambda t: of[t])
        assert collected(token_counts(df, path, rule, "s"), *COUNTS) == expected_


def test_counts_of_odd_rows_and_empty_table(spark, odd_rows, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    rows = [(r.doc_id, r.text) for r in odd_rows.collect()]
    assert collected(token_counts(odd_rows, path), *COUNTS) == brute_counts(rows, path, "first", line_sections)
    assert token_counts(empty_of(odd_rows), path).collect() == []
    df = spark.createDataFrame([(1, "a b", None), (2, None, [])], "doc_id long, text string, s array<struct<start:long,end:long>>")
    assert collected(token_counts(df, path, sections="s"), *COUNTS) == [(1, -1, 0, 0, 2, 0)]
    with pytest.raises(ValueError):
        token_counts(odd_rows, path, rule="middle")
