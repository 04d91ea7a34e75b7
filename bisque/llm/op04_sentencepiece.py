"""SentencePiece encoding and decoding by a streaming lattice walk.

Piece ends form a lattice over the text. For each end the best backpointer is found from a window no longer than the longest piece; when the
backpointer paths of all ends that later pieces can still reach run through one boundary, the ids before it are committed and forgotten.
For unigram models the best path maximises the sum of scores (Viterbi). For BPE models a sum of scores would not give the model's own ids: there
the walk keeps, per end, the one piece that the merge order allows, that is, a piece whose pair with the piece before it merges back to just
those two pieces. This gives exactly the ids that the merge procedure gives on the whole text, again from a bounded window.
No piece runs over the start of a run of blanks, so all paths converge there: such segments are encoded once and remembered, in a bounded table.

Decoding joins pieces and bytes and drops the blank put before the text.

Defined results: null texts give null ids; empty texts no ids; a literal U+2581 is a blank, as in the model's own library; characters outside
the vocabulary become their UTF-8 bytes' ids; very long texts are encoded whole; equal texts get equal ids; clashing columns are replaced.
"""

from __future__ import annotations

import os
import re
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BLANK = "▁"
#: Codes of pieces: ids, then characters without a piece, then the start of a segment. Two codes make a key.
CHARACTER, START, CODES = 1 << 21, (1 << 22) - 1, 1 << 22
INFINITE = float("inf")
MODEL = os.environ.get("BISQUE_SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
#: Segments remembered by a worker at most, pairs of pieces at most; the tables are emptied when full.
REMEMBERED, PAIRS = 80_000, 350_000
#: Segments of at most so many characters are walked side by side, so many at once; so many segments of a text are looked at together.
SHORT, ABREAST, TOGETHER = 32, 8_000, 50_000
#: Fixed value: an odd multiplier for mixing hashes.
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * ODD
        return x ^ (x >> np.uint64(29))


class Table:
    """Small numbers by 64-bit keys other than 0, asked for by whole arrays: open addressing, the next place if one is taken."""

    def __init__(self, bits: int):
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32)
        self.mask, self.size = (1 << bits) - 1, 0

    def add(self, keys: list[int], values: list[int]) -> None:
        """New keys, once each."""
        places = (mixed(np.array(keys, np.uint64)) & np.uint64(self.mask)).tolist()
        for key, value, at in zip(keys, values, places, strict=True):
            while self.keys[at]:
                at = at + 1 & self.mask
            self.keys[at], self.values[at] = key, value
        self.size += len(keys)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of keys, -1 for those that are not here."""
        out = np.full(len(keys), -1, np.int32)
        at = (mixed(keys) & np.uint64(self.mask)).astype(np.int64)
        open_ = np.arange(len(keys))
        while len(open_):
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
            at[open_] = at[open_] + 1 & self.mask
        return out


class Pieces:
    """A model's vocabulary: ids and scores by piece, byte ids, kind."""

    def __init__(self, blob: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=blob)
        n = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.unk = sp.unk_id()
        usual = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in usual}
        self.score = {self.pieces[i]: sp.get_score(i) for i in usual}
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.control = {i for i in range(n) if sp.is_control(i)}
        self.longest = max(map(len, self.ids))
        # the longest piece that ends with three given characters: a shorter window for most ends
        self.ending: dict[str, int] = {}
        for piece in self.ids:
            if len(piece) > 2:
                self.ending[piece[-3:]] = max(self.ending.get(piece[-3:], 0), len(piece))
        # all paths converge where no piece has the two characters side by side: before a run of blanks, and on the sides of a run of
        # ASCII marks, but for the few characters that some piece has beside a mark
        marks = {chr(c) for c in range(33, 127) if not chr(c).isalnum()}
        beside = {(a, b) for p in self.ids for a, b in zip(p, p[1:], strict=False)}
        if any(b == BLANK and a != BLANK for a, b in beside):
            self.segment = re.compile("(?s).+")
        else:
            m, blank = re.escape("".join(sorted(marks))), BLANK
            before = re.escape("".join(sorted({a for a, b in beside if b in marks and a not in marks and a != BLANK})))
            plain = f"(?:[^{blank}{m}]|(?<=[{before}])[{m}]+)" if before else f"[^{blank}{m}]"
            tail = f"{plain}*" if any(a in marks and b not in marks and b != BLANK for a, b in beside) else ""
            self.segment = re.compile(f"{blank}*{plain}+|{blank}*[{m}]+{tail}|{blank}+")
        # the model's own library tells the kinds apart: only a merge model gives negative ranks that are whole numbers
        self.merges = all(float(s).is_integer() for s in list(self.score.values())[:2000])


class Encoder:
    def __init__(self, vocabulary: Pieces):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.spines: dict[tuple[str, bool], list | None] = {}
        self.ends: tuple[dict, dict] = {}, {}
        self.stored: dict[int, bytes] = {}
        self.window = 0  # the most backpointers held at once, for tests

    def merged(self, text: str) -> list[str]:
        """The merge procedure itself, on a short string: best score first, leftmost on ties."""
        parts, score = list(text), self.v.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def spine(self, p: str, right: bool) -> list[tuple[str, float]] | None:
        """The parts of p that stand at its end while it is merged, smallest first, each with the rank of the merge that ends it.

        None if p is not merged into one piece, or its merges do not come in the order of their ranks.
        """
        got = self.spines.get((p, right), 0)
        if got != 0:
            return got
        parts, score, seen = list(p), self.v.score, []
        last, kept = -1.0, True
        at_end = parts[-1 if right else 0]
        while len(parts) > 1:
            found = [(-score[x], i) for i in range(len(parts) - 1) if (x := parts[i] + parts[i + 1]) in score]
            if not found:
                break
            rank, i = min(found)
            kept &= rank >= last
            last = rank
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            if parts[-1 if right else 0] != at_end:
                seen.append((at_end, rank))
                at_end = parts[-1 if right else 0]
        seen.append((at_end, INFINITE))
        got = self.spines[p, right] = seen if kept and len(parts) == 1 else None
        return got

    def text(self, code: int) -> str:
        return self.v.pieces[code] if code < CHARACTER else "" if code == START else chr(code - CHARACTER)

    def fits(self, a: int, b: int) -> bool:
        """Whether the piece of code b may follow that of code a, or start the segment."""
        rights, lefts = self.ends
        left, right = rights.get(a, 0), lefts.get(b, 0)
        if left == 0:
            left = rights[a] = self.spine(self.text(a), True) if a != START else None
        if right == 0:
            right = lefts[b] = self.spine(self.text(b), False)
        if left is None or right is None:
            x, y = self.text(a), self.text(b)
            got = self.merged(x + y) == ([x, y] if x else [y])
        else:
            # the two sides are merged independently until a merge over the boundary outranks what either side does next
            got, i, j, score = True, 0, 0, self.v.score.get
            (x, until_x), (y, until_y) = left[0], right[0]
            while True:
                c = score(x + y)
                if c is not None and -c < until_x and -c <= until_y:
                    got = False
                    break
                if until_x <= until_y:
                    if until_x == INFINITE:
                        break
                    i += 1
                    x, until_x = left[i]
                else:
                    j += 1
                    y, until_y = right[j]
        return got

    def tokens(self, p: str) -> tuple[int, ...]:
        i = self.v.ids.get(p)
        if i is not None:
            return (i,)
        return tuple(self.v.bytes[x] for x in p.encode()) if self.v.bytes else (self.v.unk,)

    def _substrings(self, points: np.ndarray, within: np.ndarray) -> list[np.ndarray]:
        """By length: the code of the piece of that length that ends with each character, -1 if there is none; ``within`` is a character's place."""
        up, down = self.powers
        with np.errstate(over="ignore"):
            run = np.zeros(len(points) + 1, np.uint64)
            np.cumsum(mixed(points + np.uint64(1)) * up[within], out=run[1:])
            codes = []
            for n in range(1, min(self.v.longest, SHORT) + 1):
                found = np.full(len(points), -1, np.int64)
                ends = np.flatnonzero(within >= n - 1)
                keys = (run[ends + 1] - run[ends + 1 - n]) * down[within[ends] - n + 1] + np.uint64(n)
                found[ends] = self.vocabulary.find(keys | np.uint64(1))
                codes.append(found)
        codes[0] = np.where(codes[0] < 0, points.astype(np.int64) + CHARACTER, codes[0])
        return codes

    @property
    def powers(self) -> tuple[np.ndarray, np.ndarray]:
        if not hasattr(self, "_powers"):
            back = pow(int(ODD), -1, 1 << 64)
            self._powers = tuple(np.array([pow(x, k, 1 << 64) for k in range(SHORT)], np.uint64) for x in (int(ODD), back))
        return self._powers

    @property
    def vocabulary(self) -> Table:
        """Ids of pieces by hash; two pieces of one hash are looked for once, when it is made."""
        if not hasattr(self, "_vocabulary"):
            up, seen = [int(x) for x in self.powers[0]], {}
            points = sorted({ord(c) for p in self.v.ids for c in p})
            code = dict(zip(points, mixed(np.array(points, np.uint64) + np.uint64(1)).tolist(), strict=True))
            for p, i in self.v.ids.items():
                if len(p) <= SHORT:
                    key = (sum(code[ord(c)] * up[k] for k, c in enumerate(p)) + len(p)) % (1 << 64) | 1
                    if seen.setdefault(key, i) != i:
                        raise ValueError("two pieces of one hash")
            self._vocabulary = Table(len(seen).bit_length() + 1)
            self._vocabulary.add(list(seen), list(seen.values()))
        return self._vocabulary

    def _may_follow(self, keys: np.ndarray) -> np.ndarray:
        """``fits`` for an array of pairs of codes."""
        if not hasattr(self, "_follow") or self._follow.size + len(keys) > PAIRS:
            self._follow = Table(19)
        ok = self._follow.find(keys)
        if (ok < 0).any():
            new = np.unique(keys[ok < 0]).tolist()
            self._follow.add(new, [int(self.fits(key // CODES - 1, key % CODES)) for key in new])
            ok = self._follow.find(keys)
        return ok > 0

    def merge_walks(self, segments: list[str]) -> list[bytes]:
        """``merge_walk`` of many segments: short ones go side by side, a character a step, each with the same window and backpointers."""
        out: list[bytes | None] = [self.merge_walk(s) if len(s) > SHORT else None for s in segments]
        order = sorted((k for k, got in enumerate(out) if got is None), key=lambda k: -len(segments[k]))
        if not order:
            return out
        size = np.array([len(segments[k]) for k in order])
        points = np.frombuffer("".join([segments[k] for k in order]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        first = np.cumsum(size) - size
        ending = self._substrings(points, np.arange(len(points)) - np.repeat(first, size))
        codes, length = np.full(len(points), START, np.int64), np.zeros(len(points), np.int64)
        for t in range(1, int(size[0]) + 1):
            ends = first[: np.searchsorted(-size, -t, "right")] + t - 1
            for n in range(min(t, len(ending)), 0, -1):
                b = ending[n - 1][ends]
                some = np.flatnonzero(b >= 0)
                if not len(some):
                    continue
                at = ends[some]
                a = codes[at - n] if n < t else np.full(len(some), START, np.int64)
                ok = self._may_follow(((a + 1) * CODES + b[some]).astype(np.uint64))
                codes[at[ok]], length[at[ok]] = b[some][ok], n
                left = np.ones(len(ends), bool)
                left[some[ok]] = False
                ends = ends[left]
        codes, length, stored = codes.tolist(), length.tolist(), self.stored
        for k, start, n in zip(order, first.tolist(), size.tolist(), strict=True):
            path, end = [], start + n - 1
            while end >= start:
                code = codes[end]
                path.append(stored.get(code) or self._tokens_of(code))
                end -= length[end]
            path.reverse()
            out[k] = b"".join(path)
        return out

    def merge_walk(self, s: str) -> bytes:
        """The ids of one segment under the merge order, packed; holds codes and backpointers of the part that is not committed yet."""
        out: list[bytes] = []
        get, ending, longest, pairs = self.v.ids.get, self.v.ending.get, self.v.longest, self.pairs
        if len(pairs) > PAIRS // 4:
            pairs.clear()
        done, last = 0, 0
        codes, back = [START], [0]  # of the piece that ends at done + index, and where it starts
        for i in range(1, len(s) + 1):
            low = i - ending(s[i - 3 : i], 2) if i > 2 else 0
            for j in range(low if low > done else done, i):
                b = get(s[j:i])
                if b is None:
                    if i - j > 1:
                        continue
                    b = CHARACTER + ord(s[j])
                a = codes[j - done]
                ok = pairs.get(a * CODES + b)
                if ok is None:
                    ok = pairs[a * CODES + b] = self.fits(a, b)
                if ok:
                    codes.append(b)
                    back.append(j)
                    break
            if i - last >= 4 * longest:
                last = i  # from here on, ends are looked at once in so many characters
                # the ends that a later piece can start from, followed back until they are one
                alive = set(range(i - longest + 1, i + 1))
                while len(alive) > 1:
                    k = max(alive)
                    alive.discard(k)
                    alive.add(back[k - done] if k > done else done)
                    if k <= done:
                        break
                b = max(alive) if len(alive) == 1 else done
                if b > done:
                    self.window = max(self.window, len(back) - 1)
                    self._commit(out, codes, back, done, b)
                    del codes[: b - done], back[: b - done]
                    done = last = b
        self._commit(out, codes, back, done, len(s))
        return b"".join(out)

    def _commit(self, out: list[bytes], codes: list[int], back: list[int], start: int, end: int) -> None:
        """Put out the ids of the best path from start to end; lists begin at start."""
        path, stored = [], self.stored
        while end > start:
            code = codes[end - start]
            path.append(stored.get(code) or self._tokens_of(code))
            end = back[end - start]
        path.reverse()
        out += path

    def _tokens_of(self, code: int) -> bytes:
        got = self.stored[code] = np.array(self.tokens(self.text(code)), np.int32).tobytes()
        return got

    def walk(self, s: str) -> list[int]:
        """The ids of one segment by the sum of scores, or by merges; holds backpointers of the part that is not committed yet."""
        if self.v.merges:
            return np.frombuffer(self.merge_walk(s), np.int32).tolist()
        out: list[int] = []
        ids, longest, score = self.v.ids, self.v.longest, self.v.score
        floor = min(score.values()) - 10.0
        back: dict[int, int] = {}  # end -> start of its last piece
        total = {0: 0.0}
        done = 0
        for i in range(1, len(s) + 1):
            top, start = None, -1
            for j in range(max(done, i - longest), i):
                p = s[j:i]
                if p not in ids and i - j > 1:
                    continue
                v = total[j] + score.get(p, floor)
                if top is None or v > top:
                    top, start = v, j
            back[i], total[i] = start, top
            if i - done >= 4 * longest:
                # the ends that a later piece can start from, followed back until they are one
                alive = set(range(i - longest + 1, i + 1))
                while len(alive) > 1:
                    k = max(alive)
                    alive.discard(k)
                    alive.add(back[k] if k > done else done)
                    if k <= done:
                        break
                b = max(alive) if len(alive) == 1 else done
                if b > done:
                    self.window = max(self.window, len(back))
                    out += self._path(s, back, done, b)
                    back = {k: v for k, v in back.items() if k > b}
                    total = {k: v for k, v in total.items() if k >= b}
                    done = b
        out += self._path(s, back, done, len(s))
        return out

    def _path(self, s: str, back: dict[int, int], start: int, end: int) -> list[int]:
        cuts = []
        while end > start:
            cuts.append((back[end], end))
            end = back[end]
        return [t for a, b in reversed(cuts) for t in self.tokens(s[a:b])]

    def encode(self, text: str | None) -> list[int] | None:
        packed = self.packed(text)
        return None if packed is None else np.frombuffer(packed, np.int32).tolist()

    def packed(self, text: str | None) -> bytes | None:
        """The ids as 32-bit numbers, in the compact form in which segments are remembered."""
        return self.packed_all([text])[0]

    def packed_all(self, texts: list[str | None]) -> list[bytes | None]:
        """``packed`` of several texts; each of their segments is walked once. A long text is taken in parts of TOGETHER segments."""
        out: list[bytes | None] = [None if t is None else b"" for t in texts]
        held: list[tuple[int, list[str]]] = []
        n = 0
        for k, t in enumerate(texts):
            if not t:
                continue
            t = BLANK + t.replace(" ", BLANK)
            if len(t) < TOGETHER:
                held.append((k, self.v.segment.findall(t)))
                n += len(held[-1][1])
            else:
                found = (m.group() for m in self.v.segment.finditer(t))
                parts = []
                while part := list(islice(found, TOGETHER)):
                    parts += self._joined([part])
                out[k] = b"".join(parts)
            if n >= TOGETHER:
                for (i, _), got in zip(held, self._joined([s for _, s in held]), strict=True):
                    out[i] = got
                held, n = [], 0
        for (i, _), got in zip(held, self._joined([s for _, s in held]), strict=True):
            out[i] = got
        return out

    def _joined(self, parts: list[list[str]]) -> list[bytes]:
        """The packed ids of each list of segments."""
        ids = dict.fromkeys(chain.from_iterable(parts))
        known, older, new = self.known, self.older, []
        for s in ids:
            got = known.get(s)
            if got is None:
                got = older.get(s)
                if got is None:
                    new.append(s)
                    continue
                known[s] = got
            ids[s] = got
        if self.v.merges:
            walked = list(chain.from_iterable(self.merge_walks(new[i : i + ABREAST]) for i in range(0, len(new), ABREAST)))
        else:
            walked = [np.array(self.walk(s), np.int32).tobytes() for s in new]
        for s, got in zip(new, walked, strict=True):
            ids[s] = got
            if len(s) <= 64:
                known[s] = got
        if len(known) > REMEMBERED // 2:  # what was not asked for in this generation is forgotten with the next
            self.older, self.known = known, {}
        return [b"".join(map(ids.__getitem__, part)) for part in parts]

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        names = self.names
        try:
            blob = b"".join([names[i] for i in ids])
        except (IndexError, TypeError):
            raise ValueError("an id outside the vocabulary") from None
        s = blob.decode("utf-8", "replace").replace(BLANK, " ")
        return s[1:] if s[:1] == " " else s

    @property
    def names(self) -> list[bytes | None]:
        """Bytes of every id, None for ids that stand for nothing."""
        if not hasattr(self, "_names"):
            known = {i: p.encode() for p, i in self.v.ids.items()} | {i: bytes([b]) for b, i in self.v.bytes.items()} | dict.fromkeys(self.v.control, b"") | {self.v.unk: " ⁇ ".encode()}
            self._names = [known.get(i) for i in range(len(self.v.pieces))]
        return self._names


_encoders: dict[bytes, Encoder] = {}


def encoder(blob: bytes) -> Encoder:
    """One a worker and model, kept from task to task."""
    import hashlib

    k = hashlib.blake2b(blob, digest_size=16).digest()
    if k not in _encoders:
        _encoders[k] = Encoder(Pieces(blob))
    return _encoders[k]


def read_model(path: str = MODEL) -> bytes:
    """The model's bytes, read on the driver and sent with the tasks (half a MB, whatever the data)."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, column: str = "text", model: str = MODEL) -> DataFrame:
    """``df`` with ``ids``, ``n_ids`` and ``decodes`` (whether the ids give the text back, but for U+2581)."""
    blob = read_model(model)

    def make():
        e = encoder(blob)

        def run(texts):
            ids = [None if b is None else np.frombuffer(b, np.int32) for b in e.packed_all(texts)]
            same = [None if t is None else e.decode(i.tolist()) == t.replace(BLANK, " ") for t, i in zip(texts, ids, strict=True)]
            return {"ids": ids, "n_ids": [None if i is None else len(i) for i in ids], "decodes": same}

        return run

    return common.map_text(df, column, "ids array<int>, n_ids long, decodes boolean", make)


def decode(df: DataFrame, column: str = "ids", model: str = MODEL) -> DataFrame:
    """``df`` with ``decoded``, the text of an array of ids."""
    blob = read_model(model)
    keep = [c for c in df.columns if c.lower() != "decoded"]
    from pyspark.sql import types as T

    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField("decoded", T.StringType())])

    def run(batches):
        import pyarrow as pa

        e = encoder(blob)
        for b in batches:
            texts = [e.decode(x) for x in b.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs).select("doc_id", "n_ids", "decodes", "ids")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: what a trainer reads, ids by document; the text stays beside them."""
    return encode(docs)
