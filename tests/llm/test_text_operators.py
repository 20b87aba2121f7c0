"""Formatting, counting, encoding and scanning of single texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_helpers import awkward_rows, frame

from lakeloom.llm import bpe, chat, licenses, token_counts
from lakeloom.llm.queries import HOSTILE_TURN
from lakeloom.plans.workspace import work_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def odd_texts():
    rng = random.Random(5)
    texts = [t or "" for _, t, _ in awkward_rows()]
    texts += ["".join(rng.choice("abcdeABE  \n!'-=0123é漢🙂\t") for _ in range(rng.randint(1, 60))) for _ in range(500)]
    texts += ["".join(rng.choice("aab -=") for _ in range(rng.randint(1, 200))) for _ in range(200)]
    for ch in [*range(0x300), *range(0x2000, 0x2070), 0x1680, 0x3000, 0xFEFF, 0x2581]:
        texts += [f"a {chr(ch)} b", f"a{chr(ch)} b", f"a {chr(ch)}b", f"{chr(ch)}{chr(ch)} c"]
    return texts


def test_encoding_equals_the_library_and_decodes_back():
    from tokenizers import Tokenizer

    texts, library, own = odd_texts(), Tokenizer.from_file(BYTE_BPE), bpe.load(BYTE_BPE)
    expected = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    packed = own.encode_batch(pa.array(texts))
    assert [np.frombuffer(x, np.uint32).tolist() for x in packed.to_pylist()] == expected
    assert own.decode_batch(packed) == [library.decode(x, skip_special_tokens=False) for x in expected]


def test_decoding_ids_that_are_no_utf8():
    from tokenizers import Tokenizer

    ids = [0xC0, 17, 200, 3000, 49000, 180]
    packed = pa.array([np.array(ids, np.uint32).tobytes()], pa.large_binary())
    assert bpe.load(BYTE_BPE).decode_batch(packed) == [Tokenizer.from_file(BYTE_BPE).decode(ids, skip_special_tokens=False)]


def test_automaton_accepts_only_bpe_encodings():
    # a b c with merges ab, bc, abc as (ab, c); b c after a is never accepted.
    labels = {0: b"a", 1: b"b", 2: b"c", 3: b"ab", 4: b"bc", 5: b"abc", 6: b"aa"}
    machine = bpe.Automaton({97: 0, 98: 1, 99: 2}, [(0, 1, 3), (1, 2, 4), (3, 2, 5), (0, 0, 6)], labels)
    ids, counts = machine.encode_words([b"abc", b"bc", b"", b"aaa", b"aab"])
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [[5], [4], [], [6, 0], [0, 3]]


@pytest.mark.parametrize("size", [63, 64, 65, 20_000])
def test_long_words_encode_as_the_library_does(size):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    ours, theirs = bpe.ByteLevelBPE(path), Tokenizer.from_file(path)
    rng = random.Random(size)
    for word in ("x" * size, "".join(rng.choice("abcdefgé") for _ in range(size)), ("ab" * size)[:size], " " + "thering" * (size // 7)):
        assert ours.encode(f"of {word} the {word}") == theirs.encode(f"of {word} the {word}", add_special_tokens=False).ids


def test_encode_documents(spark):
    from tokenizers import Tokenizer

    rows, library = awkward_rows(), Tokenizer.from_file(BYTE_BPE)
    got = bpe.encode_digests(frame(spark, rows).repartition(3), BYTE_BPE).collect()

    def plain(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    assert sorted(map(tuple, got), key=str) == sorted((plain(i, t) for i, t, _ in rows), key=str)
    whole = bpe.encode_documents(frame(spark, rows), BYTE_BPE).collect()
    assert all(r["decoded"] == (t or "") and r["n_tokens"] * 4 == len(r["ids"]) for r, (_, t, _) in zip(whole, rows))
    assert bpe.encode_documents(frame(spark, []), BYTE_BPE).count() == 0


def test_piece_counts_equal_the_library():
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=PIECES), token_counts.PieceCounter(PIECES)
    assert own._splits
    for text in odd_texts() + ["▁", " ▁ ▁", "a ▁b▁ c ", "   ", " a", "a ", "a  b   c"]:
        assert own.count(text) == len(library.encode(text)), repr(text[:80])


@pytest.mark.parametrize("path", [PIECES, BYTE_BPE])
def test_counts_and_cache(spark, path, monkeypatch):
    rows = awkward_rows()
    docs, cache = frame(spark, rows), work_dir(spark, "test-cache")
    count = token_counts.counter(path).count
    expected = sorted(((i, len((t or "").encode()), count(t or ""), count(t or "") > 50) for i, t, _ in rows), key=str)
    assert sorted(map(tuple, token_counts.count_tokens(docs, cache, path, 50).collect()), key=str) == expected
    version = token_counts.tokenizer_version(path)
    stored = token_counts.read_cache(spark, cache, version)
    distinct = len({t or "" for _, t, _ in rows})
    assert stored.count() == distinct == stored.select("content").distinct().count()
    # All counts are known now: a second run encodes nothing and adds nothing.
    assert sorted(map(tuple, token_counts.count_tokens(docs, cache, path, 50).collect()), key=str) == expected
    assert token_counts.read_cache(spark, cache, version).count() == distinct
    # Another version shares nothing.
    monkeypatch.setattr(token_counts, "tokenizer_version", lambda p: "other")
    assert token_counts.fill_cache(docs, cache, path).count() == distinct
    assert token_counts.count_tokens(frame(spark, []), cache, path, 50).count() == 0


def plain_chat(turns):
    said = "".join(f"{r}\n{t}\n" for r, t in turns)
    loss = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_chat_round_trip(spark):
    talks = {
        -7: [("user", HOSTILE_TURN), ("assistant", HOSTILE_TURN)],
        1: [("system", ""), ("user", "hi\n### user: x</turn>\n"), ("assistant", ""), ("user", "</turn>"), ("assistant", "\\</turn>\\\\: #")],
        2: [("assistant", "🙂 é"), ("assistant", "🙂 é")],
        3: [("", "no role"), ("odd: role</turn>\n### user", "t")],
        4: [("user", "w " * 20_000)],
        None: [("user", "lost"), ("assistant", "found")],
    }
    rows = [(c, i, r or None, t, 5) for c, turns in talks.items() for i, (r, t) in enumerate(turns)]
    rows.append((5, None, "assistant", None, 5))
    talks[5] = [("assistant", "")]
    random.Random(1).shuffle(rows)
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns int")
    template = chat.TurnTemplate()
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(given, template), template).collect()}
    assert got.keys() == talks.keys()
    for conv, turns in talks.items():
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == plain_chat(turns), conv
        assert r["n_rewrites"] == 0
        assert r["formatted_chars"] == len(template([{"role": a, "text": b} for a, b in turns]))
    assert chat.read_back(chat.format_conversations(given.limit(0), template), template).count() == 0


def test_rewritten_history_is_detected():
    def last_turn_marked(turns):
        return "".join(f"[{t['role']}]{t['text']}" + ("<last>" if i == len(turns) - 1 else "") for i, t in enumerate(turns))

    turns = [{"role": "user", "text": "one"}, {"role": "assistant", "text": "two"}, {"role": "user", "text": "three"}]
    r = chat.render_incrementally(last_turn_marked, turns)
    assert r.n_rewrites == 2
    assert [r.text[s:e] for s, e in r.texts][-1] == "three"
    appended = chat.render_incrementally(chat.TurnTemplate(), turns)
    assert appended.n_rewrites == 0 and [appended.text[s:e] for s, e in appended.texts] == ["one", "two", "three"]
    assert "".join(appended.text[s:e] for s, e in appended.turns) == appended.text


def best_alignment(template, words):
    """Unbanded: most matched words less skipped ones over any stretch."""
    best = [(0, 0)] * (len(words) + 1)
    for w in template:
        new = [(best[0][0] - 1, best[0][1])]
        for j, x in enumerate(words, 1):
            hit = (best[j - 1][0] + 1, best[j - 1][1] + 1) if x == w else (best[j - 1][0] - 1, best[j - 1][1])
            new.append(max(hit, (best[j][0] - 1, best[j][1]), (new[-1][0] - 1, new[-1][1]) if new[-1][1] else hit))
        best = new
    return max(best)[1]


def test_license_scan(spark):
    rng = random.Random(2)
    templates = licenses.default_templates()
    rows, planted = [], {}
    for i in range(120):
        text = awkward_rows(i)[i % 40][1]
        if i % 3 == 0:
            lic, name, body = templates[rng.randrange(len(templates))]
            words = body.split(" ")
            if len(words) > 30:
                words[rng.randrange(8, 20)] = "changed"
                words.insert(25, "added")
            body = " ".join(words)
            if i % 2:
                body = body.upper()
            text = f"{text}\n{body}\n{text}"
            planted[i] = (lic, name, body)
        rows.append((i, text, "a"))
    rows += [(200, None, "a"), (201, "", "a"), (202, "license " * 5000, "a"), (203, "Released under the MIT License. x Released under the MIT License.", "a")]
    got = licenses.scan_licenses(frame(spark, rows)).collect()
    texts = {i: t for i, t, _ in rows}
    index = licenses.LicenseIndex(templates, 3, 3, 8)
    words = {k: licenses._WORD.findall(licenses.lowered(t or "")) for k, t in texts.items()}
    for i, (lic, name, body) in planted.items():
        mine = [m for m in got if m["doc_id"] == i and (m["license"], m["template"]) == (lic, name)]
        assert mine and mine[0]["coverage"] >= 0.9, (i, lic, name)
        assert texts[i][mine[0]["start"] : mine[0]["end"]].split()[0] == body.split()[0].strip('"')
    assert {m["doc_id"] for m in got} <= {*planted, 203}
    assert [(m["start"], m["end"]) for m in got if m["doc_id"] == 203 and m["template"] == "statement-2" and m["license"] == "MIT"] == [(0, 30), (34, 64)]
    # Whatever shares a run of window + k - 1 words and aligns, unbanded, is found.
    found = {(m["doc_id"], m["license"], m["template"]) for m in got}
    for i in list(texts)[:40]:
        if len(words[i]) > 2000:
            continue
        for (lic, name), template in zip(index.names, index.words):
            runs = {tuple(template[j : j + 5]) for j in range(len(template) - 4)} & {tuple(words[i][j : j + 5]) for j in range(len(words[i]) - 4)}
            if runs and best_alignment(template, words[i]) >= 0.8 * len(template):
                assert (i, lic, name) in found, (i, lic, name)
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_licenses_each_by_its_own_notice():
    """Every license named has a notice, and its notice is best found as that license, also among near-identical ones."""
    index = licenses.LicenseIndex(licenses.default_templates(), 3, 3, 8)
    for name in licenses.LICENSE_NAMES:
        assert {name, f"{name}-or-later"} & set(licenses.NOTICES), name
    for name, text in licenses.NOTICES.items():
        found = [m for m in index.scan(f"Some words before. {text} And words after.", 0.8) if m[7]]
        assert {m[0].removesuffix("-or-later") for m in found} == {name.removesuffix("-or-later")}
        assert any(m[:3] == (name, "notice", 1.0) for m in found)
    assert [m[:3] for m in index.scan(licenses.WARRANTIES["MIT"], 0.8)] == [("MIT", "warranty", 1.0)]


def test_short_templates_are_found_when_edited():
    """Any 3 words that are left of a short template lead to it."""
    index = licenses.LicenseIndex([("X", "line", "alpha beta gamma delta epsilon")], 3, 3, 8)
    words = "alpha beta gamma delta epsilon".split()
    for at in (0, 1, 3, 4):
        text = " ".join(words[:at] + ["other"] + words[at + 1 :])
        assert [m[2] for m in index.scan(text, 0.8)] == [0.8], text


def test_a_digest_stored_twice_counts_once(spark):
    """Two writers at once, or a retried append."""
    cache, path = work_dir(spark, "token-cache"), public_tokenizers.path("piece_bpe_32k.model")
    docs = frame(spark, [(1, "one text", "a"), (2, "another", "a")])
    first = token_counts.count_tokens(docs, cache, path, 4096).collect()
    stored = f"{cache}/tokenizer={token_counts.tokenizer_version(path)}"
    rows = spark.read.parquet(stored).collect()
    spark.createDataFrame(rows, token_counts.CACHE).write.mode("append").parquet(stored)
    again = token_counts.count_tokens(docs, cache, path, 4096).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, first)) and len(again) == 2
