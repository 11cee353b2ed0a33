"""Fill-in-middle transformation with a Roaring-style boundary set.

The places where a text may be cut (its start and the end of each unit) form a
set of offsets, kept like a Roaring bitmap: offsets are grouped by their high
bits, and each group of 65 536 is an array, a bitmap or a list of runs,
whichever is smallest, with the number of members in the groups before it.  The
cut after ``k`` units is the member of rank ``k``: a binary search over the
cumulative numbers finds the container, a select inside it the offset.

The set is built one group (64 KiB of text) at a time, so a very long text needs
its own bytes and the compressed set, no list of its units.

Offsets are UTF-8 bytes; units end where characters end, so they are turned into
code points by counting the bytes that begin one.

Defined results: a null text is empty; an empty text, one that contains a marker
and one not picked by its id keep their form ``plain`` with null cuts; a null id
takes part as the empty string, so repeated rows (and rows without id) are
treated alike, and rows that share an id get cuts by the same numbers in their
own texts; a text of white space only is one unit; cuts may fall together, which
leaves a part empty.  An input column called ``fim`` (any case) is replaced, other
columns stay.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rastertab.llm.common import read

# Markers of the rearranged forms.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
GROUP = 1 << 16
ARRAY_MOST = 4096  # members up to which an array is no larger than a bitmap


class ArrayContainer:
    def __init__(self, members: np.ndarray):
        self.members = members.astype(np.uint16)

    def __len__(self) -> int:
        return len(self.members)

    def select(self, rank: int) -> int:
        return int(self.members[rank])


class BitmapContainer:
    """1024 words of 64 bits, with the members before each word."""

    def __init__(self, members: np.ndarray):
        bits = np.zeros(GROUP, np.uint8)
        bits[members] = 1
        self.bits = np.packbits(bits, bitorder="little")
        per_word = bits.reshape(-1, 64).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([[0], np.cumsum(per_word)])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        word = int(np.searchsorted(self.before, rank, side="right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[word * 8:word * 8 + 8], bitorder="little"))
        return word * 64 + int(inside[rank - self.before[word]])


class RunContainer:
    """Runs of neighbours: first member of each, and the members before it."""

    def __init__(self, members: np.ndarray):
        heads = np.flatnonzero(np.diff(members, prepend=-2) != 1)
        self.first = members[heads].astype(np.uint16)
        self.before = np.append(heads, len(members))

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, rank: int) -> int:
        run = int(np.searchsorted(self.before, rank, side="right")) - 1
        return int(self.first[run]) + rank - int(self.before[run])


def container(members: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest form of a sorted group of distinct members below 65 536."""
    runs = int(np.count_nonzero(np.diff(members, prepend=-2) != 1))
    if 4 * runs < min(2 * len(members), GROUP // 8):
        return RunContainer(members)
    return ArrayContainer(members) if len(members) <= ARRAY_MOST else BitmapContainer(members)


class BoundarySet:
    """Sorted distinct offsets by group; ``select(k)`` is the k-th (from 0)."""

    def __init__(self) -> None:
        self.groups: list[int] = []
        self.containers: list = []
        self.cumulative: list[int] = [0]

    def add_group(self, group: int, members: np.ndarray) -> None:
        """Members (low 16 bits, sorted) of a group later than all before."""
        if len(members):
            self.groups.append(group)
            self.containers.append(container(members))
            self.cumulative.append(self.cumulative[-1] + len(members))

    def __len__(self) -> int:
        return self.cumulative[-1]

    def select(self, rank: int) -> int:
        if not 0 <= rank < len(self):
            raise IndexError(rank)
        at = int(np.searchsorted(self.cumulative, rank, side="right")) - 1
        return self.groups[at] * GROUP + self.containers[at].select(rank - self.cumulative[at])


def _spaces(data: np.ndarray) -> np.ndarray:
    return (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))


def word_ends(data: np.ndarray, low: int, high: int) -> np.ndarray:
    """Offsets in [low, high) where a unit of white space and a word ends, or a
    rest of white space at the end of the text.  An offset is the number of
    bytes before it."""
    lead = max(low, 1) - 1  # offset o ends a word if byte o - 1 is of a word and byte o is not
    seen = _spaces(data[lead:high])
    if high > len(data):
        seen = np.append(seen, True)
    ends = np.flatnonzero(~seen[:-1] & seen[1:]) + lead + 1
    if high > len(data) and len(data) and _spaces(data[-1:])[0]:
        ends = np.append(ends, len(data))
    return ends


def character_ends(data: np.ndarray, low: int, high: int) -> np.ndarray:
    starts = np.flatnonzero((data[low:high] & 0xC0) != 0x80) + low
    starts = starts[starts > 0]
    return np.append(starts, len(data)) if high > len(data) and len(data) else starts


UNITS = {"words": word_ends, "characters": character_ends}


def boundaries(data: np.ndarray, unit: str = "words") -> BoundarySet:
    """Offset 0 and the end of each unit of a UTF-8 text."""
    out, ends = BoundarySet(), UNITS[unit]
    for group in range(len(data) // GROUP + 1):
        low = group * GROUP
        members = ends(data, low, low + GROUP) - low
        out.add_group(group, np.concatenate([[0], members]) if group == 0 else members)
    return out


def _code_points(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero((data[i:i + GROUP] & 0xC0) != 0x80)) for i in range(0, len(data), GROUP))


def draws(seed: int, doc_id: int | None) -> list[int]:
    """Four numbers of 32 bits from the id: two cuts, pick and form."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4)]


def rearrange(text: bytes, drawn: list[int], rate: int, spm_rate: int, unit: str) -> tuple[int, str, int | None, int | None, bytes]:
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    data = np.frombuffer(text, np.uint8)
    ends = boundaries(data, unit)
    n = len(ends) - 1
    marked = any(m.encode() in text for m in (PREFIX, SUFFIX, MIDDLE))
    if not text or marked or drawn[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = (ends.select(rank) for rank in sorted((drawn[0] % (n + 1), drawn[1] % (n + 1))))
    first, second, third = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if drawn[3] % 100 < spm_rate:
        form, output = "spm", b"".join([second, suffix, first, prefix, third, middle])
    else:
        form, output = "psm", b"".join([first, prefix, second, suffix, third, middle])
    return n, form, _code_points(data[:a]), _code_points(data[a:b]), output


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, unit: str = "words") -> DataFrame:
    """All columns and ``fim struct<n, form, prefix_chars, middle_chars, output>``:
    ``rate`` of a hundred documents are rearranged, of these ``spm_rate`` with
    the suffix first.  ``unit``: cuts fall after ``words`` or ``characters``."""
    kept = docs.drop(*[c for c in docs.columns if c.lower() == "fim"])
    lower = [c.lower() for c in kept.columns]
    at_id, at_text = lower.index("doc_id"), lower.index("text")
    made = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()),
                      ("output", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, ids = b.column(at_text).cast(pa.binary()), b.column(at_id)
            rows = [rearrange(texts[i].as_py() or b"", draws(seed, ids[i].as_py()), rate, spm_rate, unit) for i in range(b.num_rows)]
            parts = [pa.array([r[k] for r in rows], made[k].type) for k in range(made.num_fields)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.StructArray.from_arrays(parts, fields=list(made))],
                                             names=[*b.schema.names, "fim"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept.schema.fields)
    out = kept.mapInArrow(run, fields + "fim struct<n:long,form:string,prefix_chars:long,middle_chars:long,output:binary>")
    return out.withColumn("fim", F.col("fim").withField("output", F.col("fim.output").cast("string")))


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from.  A text with a marker is never
    rearranged, so the three markers of an output are its only ones."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
            .otherwise(output))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_in_middle(read(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fim.*")
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS body, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), k AS (
  SELECT *, len(units)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(units) + 1) AS k1, ('0x' || h[9:16])::BIGINT % (len(units) + 1) AS k2,
         CASE WHEN body = '' OR contains(body, '<P>') OR contains(body, '<S>') OR contains(body, '<M>')
                   OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), p AS (
  SELECT *, array_to_string(units[1:least(k1, k2)], '') AS prefix, array_to_string(units[least(k1, k2) + 1:greatest(k1, k2)], '') AS middle,
         array_to_string(units[greatest(k1, k2) + 1:], '') AS suffix
  FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN body WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(body) AS restored_sha256
FROM p
"""
