"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of up to ``chunk`` characters is encoded as a whole. A longer one is encoded chunk by
chunk; each chunk begins some way before the end of the one before, and where both encodings
hold the same token at the same place they are spliced behind it. That place is proven stable:

* a sequence of tokens is the merge result of its text if, and only if, each two neighbours
  are the merge result of theirs: the first merge across a token's end would also be the
  first one of the two tokens alone, since up to then both see the same symbols;
* all neighbours in the spliced sequence are neighbours in one of the two encodings, since
  the token before the splice stands in both.

Without a common token in the overlap (long runs of one character, say) the overlap is
widened, and the next chunk with it, so that the work stays within a constant factor of the
text's length; an overlap as long as all that came before encodes that anew.

The proof needs a vocabulary of merges over the whole text that changes no characters but
blanks and puts one blank in front, as ``piece_bpe_32k.model`` does; :class:`PieceEncoder`
checks that and refuses other models.

Defined results
* null or empty text: 0 bytes, 0 tokens;
* a very long text is one row and is counted by one task, in memory for its characters, a byte
  a token, and one chunk;
* rows sharing a ``doc_id``, and rows with a null id, are counted row by row; other input
  columns aren't read, so their names can't clash; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnmetrics.llm.common import table, text_slices

VOCABULARY = "piece_bpe_32k.model"
LIMIT = 4096
#: Characters of a chunk, and of the overlap of two chunks at first.
CHUNK, OVERLAP = 1 << 13, 1 << 7


class PieceEncoder:
    """The library's encoder, with the number of characters each id stands for."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.width = np.zeros(size, dtype=np.uint8)
        for i in range(size):
            if self.model.is_byte(i):  # a character's first byte stands for it, the others for nothing
                byte = int(self.model.id_to_piece(i)[3:5], 16)
                self.width[i] = not 0x80 <= byte < 0xC0
            elif not self.model.is_control(i) and not self.model.is_unknown(i):
                self.width[i] = len(self.model.id_to_piece(i))
        probe = " a  b \n\tééﬁÅ▁x日\U0001f600\x00  "
        if self.model.encode("") or self.places(probe)[1].sum() != len(probe) + 1:
            raise ValueError(f"{path} changes the characters of a text, so chunks can't be spliced")

    def places(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, characters of each) of a text with the blank that the library puts in front."""
        ids = np.array(self.model.encode(text, num_threads=1), dtype=np.int32)
        return ids, self.width[ids]


class _Tail:
    """The tokens so far: ids (where kept) and widths, in arrays that double when full."""

    def __init__(self, keep_ids: bool):
        self.n, self.widths = 0, np.empty(1 << 10, dtype=np.uint8)
        self.ids = np.empty(1 << 10, dtype=np.int32) if keep_ids else None

    def replace_from(self, at: int, ids: np.ndarray, widths: np.ndarray) -> None:
        """Tokens from number ``at`` on are now these."""
        need = at + len(widths)
        for name, new in (("widths", widths), ("ids", ids)):
            old = getattr(self, name)
            if old is not None:
                if need > len(old):
                    grown = np.empty(2 * need, dtype=old.dtype)
                    grown[:at] = old[:at]
                    old = grown
                    setattr(self, name, old)
                old[at:need] = new
        self.n = need

    def reach(self, chars: int) -> int:
        """Number of last tokens that cover ``chars`` characters, or all."""
        take = 64
        while take < self.n and int(self.widths[self.n - take : self.n].sum(dtype=np.int64)) < chars:
            take *= 2
        return min(take, self.n)


def encode_long(
    encoder: PieceEncoder, text: str, chunk: int = CHUNK, overlap: int = OVERLAP, keep_ids: bool = False
) -> tuple[int, int, np.ndarray | None]:
    """(tokens, times an overlap was widened, ids if kept) of a text, chunk by chunk.

    Offsets are characters of the text with the blank in front, which stands at -1.
    """
    done = min(len(text), chunk)
    tail = _Tail(keep_ids)
    tail.replace_from(0, *encoder.places(text[:done]))
    widened, wide = 0, overlap
    while done < len(text):
        start = max(0, done - wide)
        stop = min(len(text), done + max(chunk - overlap, wide))
        ids, widths = encoder.places(text[start:stop])
        if start == 0:
            cut, from_new = 0, 0
        else:
            count = tail.reach(wide)
            own = tail.widths[tail.n - count : tail.n].astype(np.int64)
            own_start = done - np.cumsum(own[::-1])[::-1]
            head = int(np.searchsorted(np.cumsum(widths, dtype=np.int64), wide, "right")) + 1
            new = widths[:head].astype(np.int64)
            new_start = start - 1 + np.cumsum(new) - new
            # Tokens as one number each. Those that stand for no character have no place of their
            # own, and what holds the blank in front stands for other characters.
            old_at, new_at = np.flatnonzero(own > 0), np.flatnonzero((new > 0) & (new_start >= start))
            _, a, b = np.intersect1d((own_start << 8 | own)[old_at], (new_start << 8 | new)[new_at], return_indices=True)
            if not len(a):
                wide, widened = 2 * wide, widened + 1
                continue
            cut, from_new = tail.n - count + int(old_at[a[0]]) + 1, int(new_at[b[0]]) + 1
        tail.replace_from(cut, ids[from_new:], widths[from_new:])
        done, wide = stop, overlap
    return tail.n, widened, tail.ids[: tail.n] if keep_ids else None


def count_tokens(
    docs: DataFrame, text: str = "text", doc: str = "doc_id", model_path: str | None = None,
    limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """(doc, n_bytes, n_tokens, over_limit, n_chars, n_widened) of every row; ``n_widened`` is how
    often two chunks of the text had no common token in their overlap. One pass, no shuffle."""
    path = model_path or public_tokenizers.path(VOCABULARY)

    def run(batches):
        encoder = PieceEncoder(path)
        for batch, texts in text_slices(batches, "text"):
            chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            tokens, widened = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            short = np.flatnonzero(chars <= chunk)
            for lo in range(0, len(short), 256):  # lists of ids of so many texts at a time
                part = short[lo : lo + 256]
                found = encoder.model.encode(texts.take(pa.array(part)).to_pylist(), num_threads=1)
                tokens[part] = [len(x) for x in found]
            for row in np.flatnonzero(chars > chunk).tolist():
                tokens[row], widened[row], _ = encode_long(encoder, texts[row].as_py(), chunk, overlap)
            n_bytes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, (n_bytes, tokens, tokens > limit, chars, widened))],
                names=[doc, "n_bytes", "n_tokens", "over_limit", "n_chars", "n_widened"],
            )

    long = T.LongType()
    schema = T.StructType(
        [T.StructField(doc, docs.schema[doc].dataType), T.StructField("n_bytes", long), T.StructField("n_tokens", long),
         T.StructField("over_limit", T.BooleanType()), T.StructField("n_chars", long), T.StructField("n_widened", long)]
    )
    return docs.select(F.col(doc), F.col(text).alias("text")).mapInArrow(run, schema)


def op11_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
