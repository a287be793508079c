"""Parameters of every operator, passed explicitly (no module-level singleton)."""

from __future__ import annotations

from dataclasses import dataclass

from sifter.functions.stopwords import ENGLISH_STOPWORDS

# Output labels of the alert level and of the machine-text
# detector, kept as the original application prints them.
LEVEL_HIGH_LABEL = "Alto"
LEVEL_MEDIUM_LABEL = "Medio"
LEVEL_LOW_LABEL = "Bajo"
AI_LABEL = "Probable IA"
HUMAN_LABEL = "Probable humano"


@dataclass(frozen=True)
class Params:
    # text
    stopwords: tuple[str, ...] = ENGLISH_STOPWORDS
    min_token_chars: int = 3  # tokens must be longer than 2 characters

    # chunking
    chunk_max_words: int = 100
    chunk_overlap_words: int = 20

    # embeddings
    embedding_dim: int = 384
    encoder_batch_size: int = 64
    encoder_id: str = "hash-signed-md5"

    # score blend
    weight_tfidf: float = 0.25
    weight_minhash: float = 0.15
    weight_semantic: float = 0.60
    level_high: float = 0.75
    level_medium: float = 0.45
    level_labels: tuple[str, str, str] = (LEVEL_HIGH_LABEL, LEVEL_MEDIUM_LABEL, LEVEL_LOW_LABEL)

    # search
    pair_search_k: int = 20
    fragments_kept: int = 5
    fragment_threshold: float = 0.50
    corpus_search_k: int = 5
    rerank_scale: float = 1.0

    # minhash
    minhash_perms: int = 128
    minhash_seed: int = 1
    lsh_bands: int = 32  # 32 bands x 4 rows = 128 slots

    # machine-written text score
    lm_add_k: float = 1.0
    ai_ppl_scale: float = 200.0
    ai_threshold: float = 0.6
    ai_labels: tuple[str, str] = (AI_LABEL, HUMAN_LABEL)

    # physical knobs
    block_rows: int = 4096  # rows per side in one similarity-grid cell
    broadcast_max_rows: int = 200_000  # largest side we broadcast after counting it
    broadcast_max_bytes: int = 256 << 20  # and its size as a float64 matrix
    score_digits: int = 12  # similarity scores are rounded to this before ranking


DEFAULT = Params()
