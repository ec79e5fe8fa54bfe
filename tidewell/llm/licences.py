"""Search for short licence notices, exact and with bounded errors.

Texts become lower-cased words joined by single blanks, so line breaks and signs don't matter. A notice of
m letters that may have k edits is split into k + 1 pieces: one of them stands unchanged in every match. All
pieces of all notices are the words of one automaton, which passes each text once; where a piece stands, the
regex library matches the notice with at most k edits in the stretch that the piece allows, from a
word's end to a word's end, and gives the match with the fewest edits. Words in brackets of a notice allow no edit.

Base labels are those of the three phrases whose words stand consecutively; labels also hold those of
notices. The score is 1 with a base label, else the largest share of a notice's letters that is unedited.

Defined results: null and empty texts have no words, no labels and score 0; repeated rows are answered
each; whole texts, whatever their length; extra columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewell.llm.batches import decoded, id_and_text, slices, texts
from tidewell.llm.units import Memo
from tidewell.session import ready

# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Fixed values: (label, notice, edits). Sentences of public licences, and their usual short names.
NOTICES = (
    ("mit", "[mit] license", 1),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    ("apache", "apache license", 1),
    ("apache", "licensed under the apache license version [2] 0", 4),
    ("gpl", "general public license", 2),
    ("gpl", "licensed under the gnu general public license", 4),
    ("lgpl", "lesser general public license", 2),
    ("agpl", "affero general public license", 2),
    ("bsd", "[bsd] license", 1),
    ("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    ("mpl", "mozilla public license", 2),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    ("cc-by", "licensed under [cc by 4 0]", 2),
    ("cc-by-nc", "licensed under [cc by nc]", 2),
    ("cc-by-sa", "licensed under [cc by sa]", 2),
    ("cc-by", "creative commons attribution", 3),
    ("unlicense", "this is free and unencumbered software released into the public domain", 6),
    ("reserved", "all rights reserved", 1),
    ("spdx", "spdx license identifier", 2),
)

#: Bytes to words: A-Z lower-cased, digits, a-z and all bytes from 0x80 stay, the rest are blanks.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Notice:
    label: str
    plain: str
    edits: int
    pattern: regex.Pattern = field(repr=False)
    pieces: tuple[tuple[int, str], ...] = field(repr=False)


def notice(label: str, text: str, edits: int) -> Notice:
    """Pieces are of near equal lengths, edits + 1 of them."""
    inside = "".join(f"{regex.escape(p)}" if k % 2 else f"(?:{regex.escape(p, special_only=True)}){{e<={edits}}}" if p else "" for k, p in enumerate(regex.split(r"[\[\]]", text)))
    plain = text.replace("[", "").replace("]", "")
    bounds = [round(k * len(plain) / (edits + 1)) for k in range(edits + 2)]
    return Notice(label, plain, edits, regex.compile(rf"(?b)(?<![\p{{L}}\p{{N}}]){inside}(?![\p{{L}}\p{{N}}])"), tuple((a, plain[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)))


@dataclass(frozen=True)
class Match:
    notice: Notice
    start: int  # in the joined words, and where the match ends
    end: int
    edits: int


class Searcher:
    def __init__(self, notices: tuple[tuple[str, str, int], ...] = NOTICES):
        self.notices = [notice(*n) for n in notices]
        seeds = defaultdict(list)
        for n in self.notices:
            for at, piece in n.pieces:
                seeds[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), tuple(places)))
        self.automaton.make_automaton()
        self.best = Memo(self._best, most=50_000, longest=1 << 30)

    def _best(self, key: tuple[Notice, str]) -> tuple[int, int, int] | None:
        n, stretch = key
        m = n.pattern.search(stretch)
        return (m.start(), m.end(), sum(m.fuzzy_counts)) if m else None

    def matches(self, joined: str) -> list[Match]:
        """Matches of all notices in words joined by blanks; of one notice's that overlap, that with the fewest edits."""
        padded, found = f" {joined} ", defaultdict(set)
        for last, (size, places) in self.automaton.iter(joined):
            for n, at in places:
                from_ = max(0, last + 1 - size - at - n.edits)
                stretch = padded[from_ : last + 1 - size - at + len(n.plain) + n.edits + 2]
                if (m := self.best[n, stretch]) is not None:
                    found[n].add((m[2], from_ + m[0] - 1, from_ + m[1] - 1))
        out = []
        for n, own in found.items():
            taken: list[tuple[int, int]] = []  # apart from each other, in order
            for edits, start, end in sorted(own):
                k = bisect_right(taken, (start, end))
                if (k == 0 or taken[k - 1][1] <= start) and (k == len(taken) or end <= taken[k][0]):
                    taken.insert(k, (start, end))
                    out.append(Match(n, start, end, edits))
        return sorted(out, key=lambda m: (m.start, m.end, m.notice.label, m.notice.plain))


def joined_words(raw: bytes | None) -> str:
    return b" ".join((raw or b"").translate(WORDS).split()).decode("utf-8", "replace")


def base_places(joined: str) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase, in order."""
    if not any(p in joined for p in PHRASES):
        return []
    padded, found = f" {joined} ", []
    for phrase, label in PHRASES.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            found.append((at, label))
            at = padded.find(f" {phrase} ", at + 1)
    out, word, before = [], 0, 0
    for at, label in sorted(found):
        word, before = word + joined.count(" ", before, at), at
        out.append((word, label))
    return out


@lru_cache(maxsize=1)
def searcher() -> Searcher:
    return Searcher()


def share(m: Match) -> float:
    return 1 - m.edits / len(m.notice.plain)


def licence_labels(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_matches."""
    ready(docs.sparkSession)
    names = [id_col, "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_matches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = searcher()
        for batch in slices(batches):
            rows = []
            for joined in map(joined_words, texts(batch)):
                base, found = base_places(joined), s.matches(joined)
                own = {label for _, label in base}
                score = 1.0 if base else max(map(share, found), default=0.0)
                every = own | {m.notice.label for m in found}
                rows.append((joined.count(" ") + 1 if joined else 0, len(base), base[0][0] if base else None, base[-1][0] if base else None, ",".join(sorted(own)), ",".join(sorted(every)), score, len(found)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True))], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_matches long")


WORD = regex.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def licence_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a match: id, label, notice, edits, first_word, n_words, from_char and to_char in the text, found (the text's own letters)."""
    ready(docs.sparkSession)
    schema = f"`{id_col}` long, label string, notice string, edits long, first_word long, n_words long, from_char long, to_char long, found string"
    kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = searcher()
        for batch in slices(batches):
            rows = []
            for id_, raw in zip(batch.column("id").to_pylist(), texts(batch), strict=True):
                joined = joined_words(raw)
                found = s.matches(joined)
                if not found:
                    continue
                text = decoded(raw)
                bounds, word, before = [m.span() for m in WORD.finditer(text)], 0, 0
                for m in found:
                    word, before = word + joined.count(" ", before, m.start), m.start
                    n = joined.count(" ", m.start, m.end) + 1
                    a = bounds[word][0] + m.start - joined.rfind(" ", 0, m.start) - 1  # signs from U+0080 on belong to words
                    b = bounds[word + n - 1][0] + m.end - joined.rfind(" ", 0, m.end) - 1
                    rows.append((id_, m.notice.label, m.notice.plain, m.edits, word, n, a, b, text[a:b]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [id_col, "label", "notice", "edits", "first_word", "n_words", "from_char", "to_char", "found"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, schema)
