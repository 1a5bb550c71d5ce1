"""Counting the terms of whole texts inside tasks.

A term is a run of ASCII letters and of characters from U+0080 on; only A-Z are
lower-cased.  In UTF-8 these are exactly the runs of the bytes a-z, A-Z and
0x80-0xFF, so one byte table turns a text into blank-separated terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa

#: the same terms as a Java, RE2 or Python pattern
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: each byte as a lower-case letter, itself (from 0x80 on) or a blank
BLANKED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
#: bytes split at once, and (group, term) entries held before they are sent on
SLICE_BYTES, FLUSH_ENTRIES = 1 << 20, 250_000

COUNTED = "lang string, source string, term string, n bigint, docs bigint"


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, in lists of about ``SLICE_BYTES``."""
    blanked, at = text.translate(BLANKED), 0
    while at < len(blanked):
        end = blanked.find(b" ", at + SLICE_BYTES)
        end = len(blanked) if end < 0 else end
        yield blanked[at:end].split()
        at = end


def term_counter() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A ``mapInArrow`` function over (lang, text binary, holders array<(source, n)>).

    Each text is split once; its terms count ``n`` times for every holder, and
    it is ``n`` documents of the holder's.  Sums of a task are held for at most
    ``FLUSH_ENTRIES`` (lang, source, term), then sent on and begun anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (counts, docs) in held.items():
                if not counts:
                    continue
                terms = pa.array(list(counts), pa.binary()).view(pa.string())
                n = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()), terms,
                        pa.array(list(counts.values()), pa.int64()),
                        pa.array([docs[t] for t in counts], pa.int64()),
                    ],
                    names=["lang", "source", "term", "n", "docs"],
                )
            held.clear()

        entries = 0
        for batch in batches:
            langs, texts, holders = (batch.column(c).to_pylist() for c in ("lang", "text", "holders"))
            for lang, text, who in zip(langs, texts, holders, strict=True):
                if len(who) == 1 and who[0]["n"] == 1:
                    counts, docs = held.setdefault((lang, who[0]["source"]), (Counter(), Counter()))
                    before, seen = len(counts), set()
                    for terms in pieces(text):
                        counts.update(terms)
                        seen.update(terms)
                    docs.update(seen)
                    entries += len(counts) - before
                else:
                    once: Counter = Counter()
                    for terms in pieces(text):
                        once.update(terms)
                    for h in who:
                        counts, docs = held.setdefault((lang, h["source"]), (Counter(), Counter()))
                        before, times = len(counts), h["n"]
                        for t, n in once.items():
                            counts[t] += n * times
                            docs[t] += times
                        entries += len(counts) - before
                if entries > FLUSH_ENTRIES:
                    yield from flushed()
                    entries = 0
        yield from flushed()

    return run
