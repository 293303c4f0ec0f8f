"""URL filters by a bit-parallel automaton over all rules at once.

Rules become globs over a canonical URL, host and path: ``*`` is any run without a slash, ``**`` any run, ``?``
one byte other than a slash, a backslash takes the next byte as it is. All globs lie in one bit vector of as
many 64-bit words as they need. A step of the automaton shifts the vectors by one bit, across words, and
masks them by the next byte; numpy takes that step for many URLs together.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylode.llm.scan import bytes_of

ALLOW, BLOCK = "allow", "block"
ONE = np.uint64(1)
TOP = np.uint64(63)


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with its subdomains, below a path; ``host`` and ``path`` are plain text."""
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path

    def globs(self) -> list[str]:
        def plain(text: str) -> str:
            return "".join(f"\\{c}" if c in "*?\\" else c for c in text)

        exact = f"{plain(self.host)}{plain(self.path)}**"
        return [exact, f"*.{exact}"]


def tokens(glob: str) -> list[tuple[str, int]]:
    """A glob as (kind, byte): kinds are byte, any, star (no slash) and all."""
    data, out, k = glob.encode(), [], 0
    while k < len(data):
        c = data[k:k + 1]
        if c == b"\\" and k + 1 < len(data):
            k += 1
            out.append(("byte", data[k]))
        elif c == b"*":
            double = data[k:k + 2] == b"**"
            k += double
            out.append(("all" if double else "star", 0))
        else:
            out.append(("any", 0) if c == b"?" else ("byte", data[k]))
        k += 1
    return out


class Automaton:
    """Shift-And masks of many globs.

    A glob has a bit for its start and one for each byte it takes. A star sits on the bit before it, which
    then also stays when it reads a byte that the star takes.
    """

    def __init__(self, globs: Sequence[str]):
        bits, starts, finals = 0, [], []
        takes: list[tuple[int, str, int]] = []
        for glob in globs:
            at = bits
            starts.append(at)
            for kind, byte in tokens(glob):
                if kind in ("byte", "any"):
                    at += 1
                takes.append((at, kind, byte))
            finals.append(at)
            bits = at + 1
        words = max(1, -(-bits // 64))
        self.move = np.zeros((256, words), np.uint64)
        self.stay = np.zeros((256, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        self.finals = np.array(finals, np.int64)
        no_slash = [b for b in range(256) if b != ord("/")]
        for at, kind, byte in takes:
            word, bit = at >> 6, ONE << np.uint64(at & 63)
            table, rows = {"byte": (self.move, [byte]), "any": (self.move, no_slash), "star": (self.stay, no_slash),
                           "all": (self.stay, range(256))}[kind]
            table[list(rows), word] |= bit
        for at in starts:
            self.start[at >> 6] |= ONE << np.uint64(at & 63)

    def run(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Which globs (columns) match each of the texts (rows) given by bytes and offsets."""
        n, sizes = len(offsets) - 1, np.diff(offsets)
        state = np.tile(self.start, (n, 1))
        order = np.argsort(-sizes, kind="stable")  # longest first: those still reading are a prefix
        state, begin, sizes = state[order], offsets[:-1][order], sizes[order]
        for k in range(int(sizes[0]) if n else 0):
            reading = int(np.searchsorted(-sizes, -k, "left"))
            byte, now = data[begin[:reading] + k], state[:reading]
            shifted = now << ONE
            shifted[:, 1:] |= now[:, :-1] >> TOP
            state[:reading] = (shifted & self.move[byte]) | (now & self.stay[byte])
        found = (state[:, self.finals >> 6] >> (self.finals & 63).astype(np.uint64)) & ONE
        out = np.zeros(found.shape, bool)
        out[order] = found.astype(bool)
        return out


def canonical(url: Column) -> tuple[Column, Column]:
    """Host, with A to Z in lower case, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce(rest, F.lit("")), r"(?s)\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(pages: DataFrame, rules: Sequence[Rule], default: str = ALLOW, batch: int = 4096) -> DataFrame:
    """One row per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the URL's path starts with the rule's. Of several the longest
    rule wins (host and path together), of equally long ones the one listed first. Without one, rule is null
    and verdict is ``default``. Null URLs and those without ``://`` have empty host and path, and empty ones
    match no rule with a host. Only the two columns are read; an empty table gives no rows.
    """
    globs = [(glob, k) for k, rule in enumerate(rules) for glob in rule.globs()]
    owner = np.array([k for _, k in globs], np.int64)
    rank = sorted(range(len(rules)), key=lambda k: (-len(rules[k].name.encode()), k))
    names = pa.array([rules[k].name for k in rank] + [None], pa.string())
    verdicts = pa.array([rules[k].verdict for k in rank] + [default], pa.string())
    place = np.argsort(rank) if rank else np.zeros(0, np.int64)

    def work(batches):
        automaton = Automaton([glob for glob, _ in globs])
        for rows in batches:
            for i in range(0, rows.num_rows, batch):
                part = rows.slice(i, batch)
                data, offsets = bytes_of(part.column(3))
                hits = automaton.run(data, offsets)
                # The best rule of a row is the least place among its hits.
                places = np.where(hits, place[owner], len(rank)) if len(rank) else np.zeros((len(hits), 1), int)
                best = pa.array(places.min(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], names.take(best), verdicts.take(best)],
                    ["page_id", "host", "path", "rule", "verdict"])

    host, path = canonical(F.col("url"))
    read = pages.select(F.col("page_id"), host.alias("host"), path.alias("path"))
    kind = dict(read.dtypes)["page_id"]
    return read.withColumn("canonical", F.concat("host", "path")).mapInArrow(
        work, f"page_id {kind}, host string, path string, rule string, verdict string")
