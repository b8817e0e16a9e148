"""Word events as a stream -> phrases, with state per utterance.

State is kept in columns: a value with the progress, a list with the words of the open phrase,
and a map with an entry for each word that came before its turn. So a word that arrives early is
written and read once, whatever else waits. A phrase leaves as soon as the next word shows that
it is closed.

Words that follow each other in a task's rows are shuffled and handed over as one row, a run; the
phrases that it closes come back as one. So what a call costs is paid for a run, not for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from voxloom.functions.timecode import TICKS_PER_MS, ticks_to_ms
from voxloom.operators.phrases import MAX_GAP_MS, MAX_WORDS, PUNCTUATION, phrase_text
from voxloom.streaming.state import keep_state_on_disk

CLOSED = "utt_id string, phrase_no bigint, from_ticks array<bigint>, to_ticks array<bigint>, words array<array<string>>"
PROGRESS = "next_seq bigint, phrase_no bigint, open int, early bigint, timer bigint"
WORD = "word string, offset_ticks bigint, duration_ticks bigint, is_last boolean"
# Words of an utterance whose numbers follow each other: the first one's number, the words' text
# and lengths, and their times and marks as little-endian arrays.
RUNS = "utt_id string, seq bigint, text string, lengths binary, offsets binary, durations binary, lasts binary"
RUN_BYTES = 1 << 20  # of words; a longer run is cut
_CLOSED_ROW = Row(*[column.split()[0] for column in CLOSED.split(", ")])
_RUN_ARROW = pa.schema(
    [("utt_id", pa.string()), ("seq", pa.int64()), ("text", pa.string())]
    + [(name, pa.binary()) for name in ("lengths", "offsets", "durations", "lasts")]
)


def word_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of utt_id, seq, word, offset_ticks, duration_ticks, is_last as runs, in their order."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        utt_id, seq, word, *numbers = batch.columns
        seqs, offsets, durations = (c.to_numpy() for c in (seq, *numbers[:2]))
        lasts = numbers[2].to_numpy(zero_copy_only=False)
        names = utt_id.dictionary_encode().indices.fill_null(-1).to_numpy()
        lengths = pc.utf8_length(word).to_numpy().astype(np.int32)
        size = np.cumsum(pc.binary_length(word).to_numpy().astype(np.int64)) // RUN_BYTES
        cut = (names[1:] != names[:-1]) | (seqs[1:] != seqs[:-1] + 1) | (size[1:] != size[:-1])
        begins = np.concatenate([[0], np.flatnonzero(cut) + 1])
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array([*begins, len(seqs)], pa.int32()), word), "")
        spans = list(zip(begins.tolist(), [*begins[1:].tolist(), len(seqs)], strict=True))

        def packed(values: np.ndarray) -> pa.Array:
            return pa.array([values[a:b].tobytes() for a, b in spans], pa.binary())

        columns = [utt_id.take(pa.array(begins)), pa.array(seqs[begins]), texts, *map(packed, (lengths, offsets, durations, lasts))]
        yield pa.RecordBatch.from_arrays(columns, schema=_RUN_ARROW)


def phrase_ends(words: list[str], offsets: np.ndarray, durations: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Whether a phrase ends after each word, as far as these words tell: the first word begins
    a phrase, and no gap is known after the last one."""
    n = len(words)
    hard = last | np.fromiter((w.endswith(PUNCTUATION) for w in words), bool, n)
    ended = offsets / TICKS_PER_MS + durations / TICKS_PER_MS
    hard[:-1] |= offsets[1:] / TICKS_PER_MS - ended[:-1] > MAX_GAP_MS
    place = np.arange(n)
    since = np.maximum.accumulate(np.where(np.concatenate([[False], hard[:-1]]), place, 0))
    return hard | ((place - since) % MAX_WORDS == MAX_WORDS - 1)


class _Utterance:
    """One utterance while its rows of a micro-batch are worked on: the words of its open phrase."""

    def __init__(self, utt_id: str, phrase_no: int, words: list[tuple]):
        self.utt_id, self.phrase_no = utt_id, phrase_no
        self.words: list[str] = []
        self.offsets = self.durations = np.empty(0, np.int64)
        self.last = np.empty(0, bool)
        self.add(words)

    def add(self, words: list[tuple]) -> None:
        if words:
            said, offsets, durations, last = zip(*words, strict=True)
            self.add_columns(list(said), np.array(offsets, np.int64), np.array(durations, np.int64), np.array(last, bool))

    def add_columns(self, words: list[str], offsets: np.ndarray, durations: np.ndarray, last: np.ndarray) -> None:
        if self.words:
            offsets, durations, last = (
                np.concatenate(c) for c in ((self.offsets, offsets), (self.durations, durations), (self.last, last))
            )
        self.words = self.words + words
        self.offsets, self.durations, self.last = offsets, durations, last

    def rows(self) -> list[tuple]:
        return list(zip(self.words, self.offsets.tolist(), self.durations.tolist(), self.last.tolist(), strict=True))

    def close(self, everything: bool = False) -> Row | None:
        """The closed phrases, if any; the words of the open one stay."""
        if not self.words:
            return None
        ends = phrase_ends(self.words, self.offsets, self.durations, self.last)
        if everything:
            ends[-1] = True
        until = np.flatnonzero(ends)
        if not len(until):
            return None
        begins = np.concatenate([[0], until[:-1] + 1])
        closed = _CLOSED_ROW(
            self.utt_id,
            self.phrase_no,
            self.offsets[begins],
            (self.offsets + self.durations)[until],
            tuple(tuple(self.words[a:b]) for a, b in zip(begins.tolist(), (until + 1).tolist(), strict=True)),
        )
        self.phrase_no += len(until)
        rest = until[-1] + 1
        self.words = self.words[rest:]
        self.offsets, self.durations, self.last = self.offsets[rest:], self.durations[rest:], self.last[rest:]
        return closed


class PhraseProcessor(StatefulProcessor):
    """Puts the words of each utterance in turn; timeout_ms closes one that gets no more."""

    def __init__(self, timeout_ms: int | None = None):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.progress = handle.getValueState("progress", PROGRESS)
        self.open = handle.getListState("open", WORD)
        self.early = handle.getMapState("early", "seq bigint", WORD)

    def _restored(self, key: tuple) -> tuple[_Utterance, int, int, int, int, bool]:
        progress = self.progress.get()
        next_seq, phrase_no, is_open, early, timer = progress or (0, 0, 0, 0, 0)
        words = list(self.open.get()) if is_open else []
        return _Utterance(key[0], phrase_no, words), next_seq, is_open, early, timer, progress is not None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        phrase, next_seq, was_open, early, timer, known = self._restored(key)
        pending: dict[int, tuple] = {}
        done = False
        for run in rows:
            lengths = np.frombuffer(run.lengths, np.int32)
            offsets, durations = np.frombuffer(run.offsets, np.int64), np.frombuffer(run.durations, np.int64)
            lasts = np.frombuffer(run.lasts, bool)
            text, ends = run.text, np.cumsum(lengths)
            words = [text[a:b] for a, b in zip((ends - lengths).tolist(), ends.tolist(), strict=True)]
            if not pending and not early and run.seq == next_seq:
                phrase.add_columns(words, offsets, durations, lasts)  # all in turn
                next_seq += len(words)
                done = done or bool(lasts.any())
            else:
                rest = zip(words, offsets.tolist(), durations.tolist(), lasts.tolist(), strict=True)
                pending.update((s, w) for s, w in enumerate(rest, run.seq) if s >= next_seq)
                due = []
                while True:
                    word = pending.pop(next_seq, None)
                    if word is None and early and self.early.containsKey((next_seq,)):
                        word = tuple(self.early.getValue((next_seq,)))
                        self.early.removeKey((next_seq,))
                        early -= 1
                    if word is None:
                        break
                    due.append(word)
                    next_seq += 1
                    done = done or word[3]
                phrase.add(due)
            if closed := phrase.close():
                yield closed

        if done:
            if known:
                self._clear(was_open, early, timer)
            return
        for seq, word in pending.items():
            early += not (early and self.early.containsKey((seq,)))
            self.early.updateValue((seq,), word)
        if phrase.words:
            self.open.put(phrase.rows())
        elif was_open:
            self.open.clear()
        if self.timeout_ms is not None:
            if timer:
                self.handle.deleteTimer(timer)
            timer = timerValues.getCurrentProcessingTimeInMs() + self.timeout_ms
            self.handle.registerTimer(timer)
        self.progress.update((next_seq, phrase.phrase_no, len(phrase.words), early, timer))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        """Nothing came for long: what is there is all there will be."""
        phrase, _, was_open, early, *_ = self._restored(key)
        if early:
            waiting = sorted((tuple(k)[0], tuple(v)) for k, v in self.early.iterator())
            phrase.add([word for _, word in waiting])
        closed = phrase.close(everything=True)
        self._clear(was_open, early, 0)
        if closed:
            yield closed

    def _clear(self, was_open: int, early: int, timer: int) -> None:
        self.progress.clear()
        if was_open:
            self.open.clear()
        if early:
            self.early.clear()
        if timer:
            self.handle.deleteTimer(timer)


def stream_phrases(words: DataFrame, timeout_ms: int | None = None) -> DataFrame:
    """Phrases from a stream of (utt_id, seq, word, offset_ticks, duration_ticks, is_last).

    seq counts the words of an utterance from 0 and may arrive in any order. The
    work of one utterance is in the order of its words, hence in one task; a rate
    limit on the source bounds how much of it a micro-batch holds. State needs a store with
    column families: in a session with Spark's default store this sets RocksDB.

    An utterance whose last word never comes is closed timeout_ms after its latest one. Give
    one to a stream that runs on; a run over available data must have none, since Spark
    keeps starting empty batches to look for timeouts.
    """
    keep_state_on_disk(words.sparkSession)
    rows = words.filter(F.col("seq").isNotNull()).select(
        "utt_id",
        F.col("seq").cast("bigint").alias("seq"),
        F.coalesce("word", F.lit("")).alias("word"),
        F.col("offset_ticks").cast("bigint").alias("offset_ticks"),
        F.col("duration_ticks").cast("bigint").alias("duration_ticks"),
        F.coalesce("is_last", F.lit(False)).alias("is_last"),
    )
    closed = rows.mapInArrow(word_runs, RUNS).groupBy("utt_id").transformWithState(
        PhraseProcessor(timeout_ms), CLOSED, "append", "none" if timeout_ms is None else "processingTime"
    )
    each = closed.select("utt_id", "phrase_no", F.posexplode(F.arrays_zip("from_ticks", "to_ticks", "words")).alias("n", "p"))
    return each.select(
        "utt_id",
        (F.col("phrase_no") + F.col("n")).alias("phrase_no"),
        ticks_to_ms(F.col("p.from_ticks")).alias("start_ms"),
        ticks_to_ms(F.col("p.to_ticks")).alias("end_ms"),
        phrase_text(F.col("p.words")).alias("text"),
    )
