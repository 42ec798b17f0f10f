"""Ids against the tokenizer library, and an exact round trip."""

import base64
import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken

from tillstream.llm import byte_bpe
from tillstream.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as f:
    RANKS = f.read()


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.Coder(byte_bpe.Vocabulary(RANKS), public_tokenizers.PATTERN)


TEXTS = [
    "", " ", "  \n\n  x", "Hello, world's  end.\t\r\n", "naïve Straße ñandú 漢字かな 🙂🏽 é", "12345 ½ ² ٣",
    "<|endoftext|> plain", "a" * 255, "a" * 256, "a" * 257, "a" * 3000, "ab" * 700, "é" * 900, "\x00\x01\x1c\x85  z", "!?" * 500,
]


def test_encode_and_decode(coder, library):
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abeinorst \n.é") for _ in range(rng.randint(1, 400))) for _ in range(150)]
    texts += ["".join(rng.choice("abceinorstlh") for _ in range(700)) for _ in range(3)]
    ids = coder.encode(texts)
    for text, got in zip(texts, ids):
        assert got.tolist() == library.encode_ordinary(text), text[:50]
    assert coder.decode(ids) == [t.encode() for t in texts]


def test_words_beyond_the_memory(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "REMEMBERED", 0)
    monkeypatch.setattr(byte_bpe, "ROWS", 9)
    fresh = byte_bpe.Coder(byte_bpe.Vocabulary(RANKS), public_tokenizers.PATTERN)
    text = "Nothing is remembered here, unrememberedly nothing."
    assert fresh.encode([text])[0].tolist() == library.encode_ordinary(text) and not fresh.known


@pytest.mark.parametrize("alphabet, n", [
    ("abcdefghijklmnopqrstuvwxyz", 20_000), ("".join(map(chr, range(0x4E00, 0x9FA5))), 7_000), ("a", 20_001), ("ab", 9_000), ("=-", 6_000),
    ("éèüñ", 5_000), (" ", 9_000), ("0123456789", 2_000), ("etaoin", 20_000), ("\n\t ", 4_000),
])
def test_long_words(coder, library, alphabet, n):
    """Words merged in parts, with what merges across their borders."""
    rng = random.Random(n)
    text = "".join(rng.choice(alphabet) for _ in range(n))
    assert coder.encode([text])[0].tolist() == library.encode_ordinary(text)


def test_time_goes_with_length(coder):
    rng = random.Random(0)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(200_000))
    han = "。".join("".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(100)) for _ in range(3_400))  # 1 MB
    for text in (word, han):
        begin = time.process_time()
        ids = coder.encode([text])
        assert time.process_time() - begin < 60
        assert coder.decode(ids) == [text.encode()]


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op3_byte_bpe"](spark, FOLDER).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, None, 5), (2, "", 5), (None, "x y", 5), (3, "x y", None), (3, "x y", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ids int")
    made = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(made, RANKS, public_tokenizers.PATTERN)
    got = sorted(((r.doc_id, len(r.ids), bytes(r.decoded)) for r in back.collect()), key=repr)
    assert got == sorted([(1, 0, b""), (2, 0, b""), (None, 2, b"x y"), (3, 2, b"x y"), (3, 2, b"x y")], key=repr)
    assert byte_bpe.decode(byte_bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN).count() == 0


def test_a_block_is_decoded_by_one_ordered_aggregation(coder, monkeypatch):
    ids, made = coder.ids, []
    run = coder._run
    monkeypatch.setattr(coder, "_run", lambda *a, **k: made.append(run(*a, **k)) or made[-1])
    texts = [[ids[b"b"], 10_000_000, ids[b"a"], -1], [], [ids[b"\xff"]], [10_000_000], [ids[b"a"]]]
    assert coder.decode([byte_bpe.np.array(t, byte_bpe.np.int32) for t in texts]) == [b"ba", b"", b"\xff", b"", b"a"]
    assert [t.num_rows for t in made] == [1]


def test_words_come_out_of_the_merge_as_rows(coder, library, monkeypatch):
    """A row for each token, without an aggregation over each word; leftmost pairs first, up to the longest short word."""
    made = []
    run = coder._run
    monkeypatch.setattr(coder, "_run", lambda *a, **k: made.append(run(*a, **k)) or made[-1])
    words = [b"q", b"zqxj", b"a" * 255, b"ab" * 127, b" unrememberedly", "\u6f22\u5b57\u304b".encode(), b"\xff\xfe\xff"]
    got = coder._merge_short(words)
    assert [t.column_names for t in made] == [["k", "tok"]] and made[0].num_rows == sum(map(len, got))
    assert [x.tolist() for x in got] == [library._encode_single_piece(w) for w in words]


def test_certain_pairs_are_merged_before_the_query(coder, library, monkeypatch):
    given = []
    run = coder._run
    monkeypatch.setattr(coder, "_run", lambda sql, **k: given.append(k) or run(sql, **k))
    words = [b" thountou", b" queche\xc3\xa7enelle", b"\xff\xfe", b"zqxj", b" ofntblest", b"ab" * 127, b"e" * 255]
    got = coder._merge_short(words)
    assert [x.tolist() for x in got] == [library._encode_single_piece(w) for w in words]
    assert len(given[0]["tok"]) < 0.8 * sum(map(len, words)) and (given[0]["tok"] > 255).any()
    assert [x.tolist() for x in coder._merge_short([b""])] == [[]]


def test_vocabularies_of_any_ranks():
    """Also where a token has a lesser rank than those that it is made of, and where bytes have any."""
    rng = random.Random(5)
    for n in range(12):
        alphabet = rng.choice([b"ab", b"abc", b"abcd"])
        longer = {bytes(rng.choices(alphabet, k=rng.randint(2, 5))) for _ in range(rng.randint(0, 40))}
        tokens = [bytes([b]) for b in range(256)] + rng.sample(sorted(longer), len(longer))
        numbers = rng.sample(range(len(tokens)), len(tokens)) if n % 2 else range(len(tokens))
        ranks = dict(zip(tokens, numbers))
        file = b"".join(b"%s %d\n" % (base64.b64encode(t), r) for t, r in ranks.items())
        words = [bytes(rng.choices(alphabet, k=rng.randint(1, 14))) for _ in range(100)]
        with byte_bpe.Coder(byte_bpe.Vocabulary(file), public_tokenizers.PATTERN) as own:
            assert [x.tolist() for x in own.merge(words)] == [_plain(ranks, w) for w in words]


def _plain(ranks, word):
    """The pair of least rank, leftmost among equals, one at a time."""
    parts = [word] if word in ranks else [bytes([b]) for b in word]
    while any(a + b in ranks for a, b in zip(parts, parts[1:])):
        _, k = min((ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks)
        parts[k:k + 2] = [parts[k] + parts[k + 1]]
    return [ranks[p] for p in parts]
