"""Token counts with overlap resynchronisation.

Short texts are counted where they lie, run by run between certain word starts; a run that a task
has seen before is not encoded again. A huge text is cut into chunks that any
task may take. Each chunk is encoded on into the next one, and so is the beginning
of the next one by itself; from the first word start that both have, they agree.
The chunk then counts its tokens up to there, less those that the next chunk will
count before it, so that the sum over chunks is the count of the whole text. Where
no word start is common, the overlap is widened up to the whole next chunk, and
after that the text is cut into longer chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.bpe import MARGIN, Bpe, Runs, blocks, default_path, load, word_starts
from lettermill.llm.common import digest16, whole_text
from lettermill.storage import stored

#: Characters of a chunk; a text of more than two is cut.
CHUNK_CHARS = 16_384
#: Characters of the first overlap; each next one is four times as long.
OVERLAP = 512
#: Chunks that fail are retried with chunks so many times as long.
LONGER = 8


def _counter(bpe: Bpe):
    """Token counts of whole texts; where words can't be told apart for certain, and in texts with special
    strings, without a look at runs."""
    if not bpe.splits:
        return lambda texts: [len(e) for e in bpe.fast(texts)]
    runs = Runs(bpe, len)

    def count(texts: list[str]) -> list[int]:
        special = [bool(bpe.special_at and bpe.special_at.search(t)) for t in texts]
        counts = iter(runs.of([t for t, s in zip(texts, special, strict=True) if not s]))
        whole = iter(bpe.fast([t for t, s in zip(texts, special, strict=True) if s]))
        return [len(next(whole)) if s else sum(next(counts)) for s in special]

    return count


def _count_whole(path: str):
    def run(batches):
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            count = lambda texts: [len(i) for i in model.encode(texts, num_threads=1)]
        else:
            count = _counter(load(path))
        for batch in batches:
            column = batch.column("text")
            texts = column.to_pylist()
            for a, b in blocks(texts):
                own = texts[a:b]
                yield pa.record_batch(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pc.cast(pc.binary_length(column.slice(a, b - a)), pa.int64()),
                        pa.array(count(own), pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    return run


def cut(text: str, size: int) -> list[tuple[str, str, bool]]:
    """(own, ahead, whether ahead reaches the end) of each chunk; ahead is the whole next chunk."""
    starts = range(0, max(len(text), 1), size)
    return [(text[s : s + size], text[s + size : s + 2 * size], s + 2 * size >= len(text)) for s in starts]


def share(bpe: Bpe, own: str, ahead: str, ends: bool) -> int | None:
    """Tokens that the chunk adds to the count; None if no overlap gives a common word start."""
    if not ahead:
        return len(bpe.ids([own])[0])
    overlap = OVERLAP
    while True:
        part = ahead[:overlap]
        done = len(part) == len(ahead)
        with_it, alone = bpe.encode([own + part, part])
        if done and ends:  # both reach the end of the text
            return len(with_it) - len(alone)
        places, tokens = word_starts(with_it)
        places = places - len(own)
        next_places, next_tokens = word_starts(alone)
        _, i, j = np.intersect1d(places, next_places, return_indices=True)
        sure = [(int(tokens[a]), int(next_tokens[b])) for a, b in zip(i, j, strict=True)
                if 0 < next_places[b] <= len(part) - MARGIN]
        if sure:
            return sure[0][0] - sure[0][1]
        if done:
            return None
        overlap *= 4


def _cut_rows(size: int):
    def run(batches):
        for batch in batches:
            for body, text in zip(batch.column("body").to_pylist(), batch.column("text").to_pylist(), strict=True):
                chunks = cut(text, size)
                for a in range(0, len(chunks), 64):
                    some = chunks[a : a + 64]
                    yield pa.record_batch(
                        [
                            pa.array([body] * len(some), pa.binary()),
                            pa.array(range(a, a + len(some)), pa.int32()),
                            pa.array([c[0] for c in some]),
                            pa.array([c[1] for c in some]),
                            pa.array([c[2] for c in some]),
                        ],
                        names=["body", "no", "own", "ahead", "ends"],
                    )

    return run


def _share_rows(path: str):
    def run(batches):
        bpe = load(path)
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("own", "ahead", "ends")), strict=True)
            yield pa.record_batch(
                [batch.column("body"), batch.column("no"), pa.array([share(bpe, *r) for r in rows], pa.int64())],
                names=["body", "no", "tokens"],
            )

    return run


def _count_cut(huge: DataFrame, path: str, size: int) -> DataFrame:
    """body, n_tokens (null where a chunk found no common word start) of each text, by its digest."""
    rows = huge.select("body", "text").mapInArrow(
        _cut_rows(size), "body binary, no int, own string, ahead string, ends boolean"
    )
    counted = rows.hint("rebalance").mapInArrow(_share_rows(path), "body binary, no int, tokens long")
    once = counted.groupBy("body", "no").agg(F.max("tokens").alias("tokens"))  # copies of a text count once
    return once.groupBy("body").agg(
        F.when(F.count("tokens") == F.count("no"), F.sum("tokens")).alias("n_tokens")
    )


def count_tokens(docs: DataFrame, path: str | None = None, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens of every whole text.

    Files of the tokenizers library that cut texts into words by ByteLevel are counted in
    chunks; other ones, and sentencepiece's, text by text. A null or empty text has none.
    A repeated row gives equal rows; rows without doc_id keep null. An empty table gives an
    empty table; other columns are ignored.
    """
    path = path or default_path()
    out = "doc_id long, n_bytes long, n_tokens long"
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    if path.endswith(".model") or not load(path).splits:
        return texts.mapInArrow(_count_whole(path), out)
    is_huge = F.length("text") > 2 * chunk_chars
    short = texts.filter(~is_huge).mapInArrow(_count_whole(path), out)
    huge = texts.filter(is_huge).withColumn("body", digest16(F.col("text")))
    counts = stored(_count_cut(huge, path, chunk_chars), "token-counts")
    size, failed = chunk_chars, counts.filter(F.col("n_tokens").isNull())
    while failed.count():  # texts without word boundaries; the chunks soon hold them whole
        size *= LONGER
        again = _count_cut(huge.join(failed.select("body"), "body", "left_semi"), path, size)
        counts = stored(counts.filter(F.col("n_tokens").isNotNull()).unionByName(again), "token-counts")
        failed = counts.filter(F.col("n_tokens").isNull())
    sized = huge.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "body")
    return short.unionByName(sized.join(counts, "body").select("doc_id", "n_bytes", "n_tokens"))


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    counted = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)
