"""The digest columns of registered queries against plain Python over the whole smallest tables."""

import hashlib
import re
import zlib

import public_tokenizers
import regex
import tiktoken
from tiktoken.load import load_tiktoken_bpe

from conftest import SMALL_SF
from mentidero.llm import queries
from mentidero.llm.common import table


def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in table(spark, SMALL_SF, "documents").select("doc_id", "text").collect()}


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def test_op4_digests(spark):
    encoding = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(queries.RANKS), special_tokens={})
    expected = {}
    for doc_id, text in documents(spark).items():
        ids = [i for part in regex.findall(public_tokenizers.PATTERN, text) for i in encoding._core_bpe.encode_single_piece(part.encode())]
        raw = b"".join(encoding.decode_single_token_bytes(i) for i in ids)
        expected[doc_id] = (len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(raw))
    got = queries.op4_byte_bpe(spark, SMALL_SF).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got} == expected and len(got) == len(expected)


def test_op8_items_and_verdicts(spark):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words_of = lambda text: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    windows = {}
    for r in table(spark, SMALL_SF, "benchmark").collect():
        words = words_of(r["text"])
        for i in range(max(1, len(words) - 12) if words else 0):
            windows.setdefault(tuple(words[i : i + 13]), set()).add(str(r["item_id"]))
    sizes = sorted({len(w) for w in windows})
    expected = {}
    for doc_id, text in documents(spark).items():
        words, hit, items = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := windows.get(tuple(words[i : i + n])):
                    hit.update(range(i, i + n))
                    items |= found
        expected[doc_id] = (len(words), len(hit), len(items), sha(",".join(sorted(items))), len(hit) > 0 and 20 * len(hit) >= len(words))
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in queries.op8_suffix_decontamination(spark, SMALL_SF).collect()}
    assert got == expected


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def test_op7_base_spans(spark):
    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15),
    ]
    got = {r["doc_id"]: r for r in queries.op7_boosted_pii(spark, SMALL_SF).collect()}
    for doc_id, text in documents(spark).items():
        spans = [f"{kind}:{m.start()}:{m.end()}" for kind, pattern, keeps in rules for m in re.finditer(pattern, text) if keeps(m)]
        assert got[doc_id]["base_sha256"] == sha(",".join(spans))
        assert [got[doc_id][f"n_{kind}"] for kind, _, _ in rules] == [sum(s.startswith(kind) for s in spans) for kind, _, _ in rules]
        assert set(spans) <= set(got[doc_id]["spans"].split(",")) or not spans


def test_op6_columns(spark):
    got = queries.op6_toxicity(spark, SMALL_SF).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(documents(spark))
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
