from dataclasses import replace

from hypothesis import given, settings
from hypothesis import strategies as st

from sifter.operators.chunking import chunk_bounds, chunk_documents


def greedy_loop(counts, max_words, overlap_words):
    """Literal statement of the chunking rule, sentence by sentence."""
    chunks, current, words = [], [], 0
    for i, n in enumerate(counts):
        if words + n > max_words and current:
            chunks.append((current[0], current[-1]))
            keep, kept = [], 0
            for j in reversed(current):
                if kept + counts[j] > overlap_words:
                    break
                keep.insert(0, j)
                kept += counts[j]
            current, words = keep, kept
        current.append(i)
        words += n
    if current:
        chunks.append((current[0], current[-1]))
    return chunks


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=140), max_size=60),
       st.integers(min_value=1, max_value=120), st.integers(min_value=0, max_value=40))
def test_bounds_match_literal_rule(counts, mx, ov):
    assert chunk_bounds(counts, mx, ov) == greedy_loop(counts, mx, ov)


def test_edges():
    assert chunk_bounds([], 100, 20) == []
    assert chunk_bounds([150], 100, 20) == [(0, 0)]  # over-long sentence stays whole
    assert chunk_bounds([50, 50], 100, 20) == [(0, 1)]  # exactly 100 words fit
    assert chunk_bounds([60, 20, 40], 100, 20) == [(0, 1), (1, 2)]  # overlap of exactly 20
    assert chunk_bounds([60, 30, 40], 100, 20) == [(0, 1), (2, 2)]  # last sentence > 20: no overlap


def test_spark_chunks(spark, params):
    p = replace(params, chunk_max_words=5, chunk_overlap_words=2)
    docs = spark.createDataFrame(
        [(1, "One two three. Four five. Six seven eight nine ten eleven. Twelve."),
         (2, "   "), (3, "single sentence without end")], "doc_id bigint, text string")
    rows = {(r.doc_id, r.chunk_no): r for r in chunk_documents(docs, "doc_id", p).collect()}
    assert rows[(1, 0)].chunk == "One two three. Four five."
    assert rows[(1, 1)].chunk == "Four five. Six seven eight nine ten eleven."
    assert rows[(1, 2)].chunk == "Twelve."
    assert rows[(1, 1)].n_words == 8
    assert rows[(2, 0)].chunk == "   " and rows[(2, 0)].first_sent is None  # no sentence: whole text
    assert rows[(3, 0)].chunk == "single sentence without end"


def test_non_overlapping_chunks_rebuild_text(spark, params):
    p = replace(params, chunk_max_words=12, chunk_overlap_words=0)
    text = " ".join(f"Sentence number {i} has some words." for i in range(30))
    docs = spark.createDataFrame([(7, text)], "doc_id bigint, text string")
    chunks = [r.chunk for r in chunk_documents(docs, "doc_id", p).orderBy("chunk_no").collect()]
    assert " ".join(chunks) == text
