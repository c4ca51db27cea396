"""Alignment against the tokenizers themselves and a plain merge."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from review_topics.llm import alignment, queries


def plain(rows):
    """Rows of the query by dictionaries and loops."""
    a, b = alignment.byte_bpe_50k(), alignment.piece_bpe_32k()
    exact = Tokenizer.from_file(a.json_path)
    exact.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=b.model_path)
    to_byte = alignment.byte_characters()
    spell_a = lambda i: bytes(to_byte[c] for c in exact.id_to_token(i))
    spell_b = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    found, counts = [], Counter()
    for doc_id, text in rows:
        ids_a = exact.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = pieces.encode(text) if text else []
        whole = f" {text}".encode()
        if not text or b"".join(map(spell_a, ids_a)) != whole or b"".join(map(spell_b, ids_b)) != whole:
            ids_a, ids_b = [], []
        ends = []
        for ids, spell in ((ids_a, spell_a), (ids_b, spell_b)):
            at, own = 0, {}
            for k, i in enumerate(ids):
                at += len(spell(i))
                own[at] = k
            ends.append(own)
        cuts = sorted(set(ends[0]) & set(ends[1]))
        links = [(ids_a[ends[0][c]], ids_b[ends[1][c]]) for c in cuts]
        counts.update(links)
        groups, i, j = [], 0, 0
        for c in cuts:
            groups.append(",".join(map(str, ids_a[i : ends[0][c] + 1])) + "|" + ",".join(map(str, ids_b[j : ends[1][c] + 1])))
            i, j = ends[0][c] + 1, ends[1][c] + 1
        found.append((doc_id, len(ids_a), len(ids_b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    most = Counter()
    for (_, i), n in counts.items():
        most[i] = max(most[i], n)
    return sorted(
        ((d, a, b, len(links), len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha) for d, a, b, links, sha in found),
        key=str,
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(COLUMNS).collect()), key=str)


def test_whole_query(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert rows_of(queries.QUERIES["op13_tokenizer_alignment"](spark, sf)) == plain(docs)


def test_odd_rows(spark, tmp_path):
    texts = [
        None, "", " ", "  two  blanks ", "a\r\n\tb", "<|endoftext|>", "<s> </s><unk><0x41>", "naïve Äpfel — “x”", "日本語 текст 🙂🙂", "é é",
        "one▁two", "\x00\x01", "ﬁ ligature nbsp", "x" * 3000, "ab " * 4000, "same", "same", "​﻿", "12345 1,234.5", "�",
    ]
    rows = [*enumerate(texts), (3, "again"), (None, "no id"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("a_ids", F.lit(1))
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(queries.QUERIES["op13_tokenizer_alignment"](spark, str(tmp_path))) == plain(rows)
    df.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert queries.QUERIES["op13_tokenizer_alignment"](spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("lane", [1, 3, 16, 10**6])
def test_lockstep_finds_every_common_end(lane):
    rng = random.Random(lane)
    for _ in range(40):
        sizes = [rng.choice([0, 1, 5, 40]) for _ in range(rng.randint(1, 6))]
        edges = np.cumsum([0, *sizes])
        sides = []
        for _ in range(2):
            ends = sorted({int(e) for e in edges[1:]} - {0} | {rng.randint(1, int(edges[-1])) for _ in range(rng.randint(0, 60)) if edges[-1]})
            sides.append(np.array(ends, np.int64))
        a, b = alignment.lockstep(*sides, edges, lane)
        assert sides[0][a].tolist() == sides[1][b].tolist() == sorted(set(sides[0].tolist()) & set(sides[1].tolist()))


def test_a_long_text_is_merged_in_lanes():
    ends = np.arange(1, 2_000_001)
    a, b = alignment.lockstep(ends, ends[1::2], np.array([0, 2_000_000]))
    assert len(a) == len(b) == 1_000_000


def test_links_are_possible_pairs():
    a, b = alignment.byte_bpe_50k(), alignment.piece_bpe_32k()
    bound = alignment.possible_pairs(a, b)
    assert 32_000 < bound < 1_000_000


def test_group_texts(spark):
    part = alignment.Groups((np.array([7, 123, 50256]), np.array([0, 10, 99])), (np.array([0, 0, 2, 3]), np.array([0, 0, 1, 3])), (np.array([2, 1]), np.array([1, 2])), np.array([0, 0, 1, 2]))
    assert alignment.group_texts(part).to_pylist() == ["", "7,123|0", "50256|10,99"]
    assert part.links(1000).tolist() == [123_000, 50_256_099]
    none = alignment.Groups((np.zeros(0, int),) * 2, (np.zeros(2, int),) * 2, (np.zeros(0, int),) * 2, np.zeros(2, int))
    assert alignment.group_texts(none).cast(pa.string()).to_pylist() == [""]
    rows = alignment.align(spark.createDataFrame([(1, "legroom")], "doc_id long, text string"), alignment.byte_bpe_50k(), alignment.piece_bpe_32k()).collect()
    assert rows[0]["n_groups"] == rows[0]["groups"].count("|") and len(rows[0]["links"]) == 4 * rows[0]["n_groups"]
