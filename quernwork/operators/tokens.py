"""Byte-level token sequences, rendered conversations, byte-pair training and packing into rows."""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .conversations import without_system

#: Special tokens in their order (fixed values); with a byte vocabulary their ids follow 255.
SPECIALS = (
    "<|bos|>", "<|user_start|>", "<|user_end|>", "<|assistant_start|>", "<|assistant_end|>",
    "<|python_start|>", "<|python_end|>", "<|output_start|>", "<|output_end|>",
)
#: Pattern that cuts a text before byte pairs are learned (fixed value; digits in twos).
SPLIT = (
    r"'(?i:[sdmt]|ll|ve|re)|[^\r\n\p{L}\p{N}]?+\p{L}+|\p{N}{1,2}| ?[^\s\p{L}\p{N}]++[\r\n]*|\s*[\r\n]|\s+(?!\S)|\s+"
)
BYTES = 256


def special_id(name: str, first: int = BYTES) -> int:
    return first + SPECIALS.index(name)


def special_tokens(spark: SparkSession, first: int = BYTES) -> DataFrame:
    """(token_id, name) of the special tokens."""
    return spark.createDataFrame([(first + i, s) for i, s in enumerate(SPECIALS)], "token_id int, name string")


def first_given(*values: Column) -> Column:
    """The first setting that is given."""
    return F.coalesce(*values)


def compression(sized: DataFrame, keys: list[str]) -> DataFrame:
    """Bytes a token of (keys, n_bytes, n_tokens, n_base), against those of the base tokenizer: ratio, base_ratio, by how
    many percent the one is above the other, and which is better. Texts without tokens must be left out."""
    sums = sized.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n_bytes", "n_tokens", "n_base")])
    ratio, base = F.try_divide("n_bytes", "n_tokens"), F.try_divide("n_bytes", "n_base")
    verdict = F.when(ratio > base, "better").when(ratio < base, "worse").otherwise("tie")
    return sums.withColumns(
        {"ratio": F.round(ratio, 9), "base_ratio": F.round(base, 9), "difference": F.round((ratio - base) / base * 100, 6), "verdict": verdict}
    )


def byte_ids(text: Column) -> Column:
    """The UTF-8 bytes of a text as ids 0..255. Each byte is read as the sign of that number."""
    signs = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    found = F.transform(F.split(signs, ""), lambda c: F.ascii(c))
    return F.when(F.length(signs) > 0, found).when(text.isNotNull(), F.array().cast("array<int>"))


def pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?U){SPLIT}"), F.lit(0))


def pretoken_counts(df: DataFrame, text: str = "text") -> DataFrame:
    return df.select(F.explode(pretokens(F.col(text))).alias("pretoken")).groupBy("pretoken").agg(
        F.count("*").alias("n")
    )


def train_pairs(counts: list[tuple[str, int]], merges: int) -> list[tuple[bytes, bytes, int]]:
    """Merges learned from pretokens and their frequencies: (left, right, frequency) in order. Of equally frequent
    pairs the one of smaller bytes is merged first. Pair counts are kept up to date word by word."""
    words = [[bytes([b]) for b in w.encode()] for w, _ in counts]
    freq = [n for _, n in counts]
    pairs: Counter = Counter()
    where: dict[tuple, set[int]] = defaultdict(set)
    for i, word in enumerate(words):
        for pair in zip(word, word[1:]):
            pairs[pair] += freq[i]
            where[pair].add(i)
    heap = [(-n, p) for p, n in pairs.items()]
    heapq.heapify(heap)
    out: list[tuple[bytes, bytes, int]] = []
    while heap and len(out) < merges:
        n, pair = heapq.heappop(heap)
        if pairs.get(pair, 0) != -n or not n:
            continue
        out.append((*pair, -n))
        changed = set()
        for i in sorted(where.pop(pair)):
            word, new, k = words[i], [], 0
            for p in zip(word, word[1:]):
                pairs[p] -= freq[i]
                changed.add(p)
            while k < len(word):
                if k + 1 < len(word) and (word[k], word[k + 1]) == pair:
                    new.append(word[k] + word[k + 1])
                    k += 2
                else:
                    new.append(word[k])
                    k += 1
            words[i] = new
            for p in zip(new, new[1:]):
                pairs[p] += freq[i]
                where[p].add(i)
                changed.add(p)
        for p in changed:
            if pairs[p] > 0:
                heapq.heappush(heap, (-pairs[p], p))
            else:
                pairs.pop(p, None)
    return out


def train_bpe(df: DataFrame, text: str, vocabulary: int, most_pretokens: int = 1 << 20) -> DataFrame:
    """(token_id, token, n): bytes, then merges. Counting is distributed; merges are learned on the driver from the
    distinct pretokens, which are refused beyond ``most_pretokens`` (a documented bound)."""
    counts = pretoken_counts(df, text).orderBy(F.desc("n"), "pretoken").limit(most_pretokens + 1).collect()
    if len(counts) > most_pretokens:
        raise ValueError(f"more than {most_pretokens} pretokens")
    learned = train_pairs([(r.pretoken, r.n) for r in counts], max(0, vocabulary - BYTES - len(SPECIALS)))
    rows = [(i, bytes([i]), 0) for i in range(BYTES)]
    rows += [(BYTES + i, a + b, n) for i, (a, b, n) in enumerate(learned)]
    rows += [(BYTES + len(learned) + i, s.encode(), 0) for i, s in enumerate(SPECIALS)]
    return df.sparkSession.createDataFrame(rows, "token_id int, token binary, n bigint")


def token_bytes(vocabulary: DataFrame, exact: bool = False) -> DataFrame:
    """(token_id, n_bytes): bytes of each decoded token, 0 for specials. A piece that is no UTF-8 by itself decodes to
    the replacement sign for each broken part, which counts three bytes, unless ``exact``."""
    special = F.col("token").isin(*[s.encode() for s in SPECIALS])
    shown = F.octet_length(F.make_valid_utf8(F.col("token").cast("string")))
    size = F.octet_length("token") if exact else shown
    return vocabulary.select("token_id", F.when(special, 0).otherwise(size).cast("int").alias("n_bytes"))


_MARKS = {
    "user": ("<|user_start|>", "<|user_end|>"), "assistant": ("<|assistant_start|>", "<|assistant_end|>"),
    "python": ("<|python_start|>", "<|python_end|>"), "python_output": ("<|output_start|>", "<|output_end|>"),
}


def _mark(kind: str, end: int) -> Column:
    return F.array(F.lit(special_id(_MARKS[kind][end])))


def _filled(flag: Column | int, size: Column) -> Column:
    return F.array_repeat(F.lit(flag) if isinstance(flag, int) else flag, size)


def _cut(ids: Column, mask: Column, most: int | None) -> Column:
    cut = lambda x: x if most is None else F.slice(x, 1, most)
    return F.struct(cut(ids).alias("ids"), cut(mask).alias("mask"))


def render(messages: Column, most: int | None = 2048) -> Column:
    """struct(ids, mask) of an array of struct(role, content) over the byte vocabulary. A system message at the head
    joins the user message after it; the answers and their end marks are learned (mask 1)."""
    told = without_system(messages)

    def ids(m: Column) -> Column:
        user = m["role"] == "user"
        side = lambda end: F.when(user, _mark("user", end)).otherwise(_mark("assistant", end))
        return F.concat(side(0), byte_ids(m["content"]), side(1))

    def mask(m: Column) -> Column:
        learned = F.when(m["role"] == "user", 0).otherwise(1)
        return F.concat(F.array(F.lit(0)), _filled(learned, F.octet_length(m["content"]) + 1))

    bos = F.array(F.lit(special_id("<|bos|>")))
    all_ids = F.concat(bos, F.flatten(F.transform(told, ids)))
    all_mask = F.concat(F.array(F.lit(0)), F.flatten(F.transform(told, mask)))
    return _cut(all_ids, all_mask, most)


def render_parts(messages: Column, most: int | None = 2048) -> Column:
    """As ``render``, of an array of struct(role, parts), parts an array of struct(type, text).

    Users' parts are not learned, whatever their type. Of an answer, ``text`` is learned, ``python`` too with its marks,
    and ``python_output``, which is not the model's own, is not learned, nor are its marks. A part of another type makes
    the whole null.
    """

    def part(p: Column, user: Column) -> Column:
        text, size = byte_ids(p["text"]), F.octet_length(p["text"])
        kind = p["type"]
        learned = F.when(user | (kind == "python_output"), 0).otherwise(1)
        marked = lambda name: F.struct(
            F.concat(_mark(name, 0), text, _mark(name, 1)).alias("ids"), _filled(learned, size + 2).alias("mask")
        )
        bare = F.struct(text.alias("ids"), _filled(learned, size).alias("mask"))
        return F.when(user | (kind == "text"), bare).when(kind == "python", marked("python")).when(kind == "python_output", marked("python_output"))

    def message(m: Column) -> Column:
        user = m["role"] == "user"
        inner = F.transform(m["parts"], lambda p: part(p, user))
        side = lambda end: F.when(user, _mark("user", end)).otherwise(_mark("assistant", end))
        ids = F.concat(side(0), F.flatten(F.transform(inner, lambda x: x["ids"])), side(1))
        mask = F.concat(F.array(F.lit(0)), F.flatten(F.transform(inner, lambda x: x["mask"])), F.array(F.when(user, 0).otherwise(1)))
        return F.struct(ids.alias("ids"), mask.alias("mask"))

    whole = F.transform(messages, message)
    ids = F.concat(F.array(F.lit(special_id("<|bos|>"))), F.flatten(F.transform(whole, lambda x: x["ids"])))
    mask = F.concat(F.array(F.lit(0)), F.flatten(F.transform(whole, lambda x: x["mask"])))
    return _cut(ids, mask, most)


def render_request(messages: Column) -> Column:
    """Ids of a request: users' and assistants' messages as they come, others left out, nothing merged and nothing cut
    off, then the mark that asks for an answer."""
    said = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    one = lambda m: F.concat(
        F.when(m["role"] == "user", _mark("user", 0)).otherwise(_mark("assistant", 0)), byte_ids(m["content"]),
        F.when(m["role"] == "user", _mark("user", 1)).otherwise(_mark("assistant", 1)),
    )
    return F.concat(F.array(F.lit(special_id("<|bos|>"))), F.flatten(F.transform(said, one)), _mark("assistant", 0))


def shift_targets(ids: Column, mask: Column) -> tuple[Column, Column]:
    """Inputs (all but the last) and targets (all but the first, -1 where not learned)."""
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    learned = F.zip_with(F.slice(ids, F.lit(2), n), F.slice(mask, F.lit(2), n), lambda i, m: F.when(m == 1, i).otherwise(-1))
    return F.slice(ids, F.lit(1), n), learned


_PACKED = T.StructType([
    T.StructField("rank", T.IntegerType()), T.StructField("row", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("content", T.IntegerType()),
    T.StructField("cropped", T.IntegerType()),
])


class _Buffer:
    """Sequences by length, first come first among equal lengths."""

    def __init__(self) -> None:
        self.order: list[tuple[int, int]] = []
        self.held: dict[int, list[int]] = {}
        self.next = 0

    def add(self, ids: list[int]) -> None:
        insort(self.order, (len(ids), -self.next))
        self.held[-self.next] = ids
        self.next += 1

    def largest(self, room: int) -> list[int] | None:
        """The longest that fits, the earliest of equal ones."""
        i = bisect_right(self.order, (room, 1)) - 1
        return self.held.pop(self.order.pop(i)[1]) if i >= 0 else None

    def shortest(self) -> list[int]:
        """The shortest, the earliest of equal ones."""
        size = self.order[0][0]
        i = bisect_right(self.order, (size, 1)) - 1
        return self.held.pop(self.order.pop(i)[1])


def pack_rows(
    sequences: Iterator[list[int]], capacity: int, buffer: int, crop: bool, pad: int, cut_long: bool = True
) -> Iterator[tuple[list[int], int, int]]:
    """(row, content, cropped) until the sequences end. A row takes the longest buffered sequence that fits, again and
    again; when none fits, the shortest is cropped to fill it, or the row is padded. At the end the buffer empties and
    the last row is padded in either case. With padding, a sequence longer than a row, which would never fit, is cut
    off with ``cut_long`` and refused without."""
    held, more = _Buffer(), True
    too_long = capacity if not crop and cut_long else None
    while True:
        row: list[int] = []
        cropped = 0
        while len(row) < capacity:
            while more and len(held.order) < buffer:
                found = next(sequences, None)
                if found is None:
                    more = False
                elif found:
                    if not crop and not cut_long and len(found) > capacity:
                        raise ValueError(f"a sequence of {len(found)} ids does not fit a row of {capacity}")
                    cut = found[:too_long]
                    cropped += len(found) - len(cut)
                    held.add(cut)
            if not held.order:
                break
            room = capacity - len(row)
            fits = held.largest(room)
            if fits is None:
                if not crop:
                    break
                short = held.shortest()
                cropped += len(short) - room
                fits = short[:room]
            row += fits
        if not row:
            return
        content = len(row)
        yield row + [pad] * (capacity - content), content, cropped


def bits_per_byte(losses: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, bpb, n_bytes) of (keys, target, nats): the losses of targets that have bytes, over ln 2 times their bytes;
    targets below 0 are ignored, and no bytes at all give infinity. ``sizes`` (target, n_bytes) is a bounded table."""
    met = losses.join(F.broadcast(sizes), "target", "left")
    n = F.coalesce(F.when(F.col("target") >= 0, F.col("n_bytes")), F.lit(0))
    sums = met.groupBy(*keys).agg(F.sum(F.when(n > 0, F.col("nats"))).alias("_nats"), F.sum(n).cast("bigint").alias("n_bytes"))
    bpb = F.when(F.col("n_bytes") > 0, F.col("_nats") / (F.log(F.lit(2.0)) * F.col("n_bytes"))).otherwise(F.lit(float("inf")))
    return sums.select(*keys, bpb.alias("bpb"), "n_bytes")


def ignored_padding(targets: Column, content: Column, capacity: int) -> Column:
    """Targets of a row of which ``content`` ids are no padding: -1 from the last of them on, in rows that are padded."""
    return F.when(content < capacity, F.transform(targets, lambda t, i: F.when(i >= content - 1, -1).otherwise(t))).otherwise(targets)


def pack(
    df: DataFrame, ranks: int, capacity: int, buffer: int, crop: bool, order: str = "order_key", cut_long: bool = True
) -> DataFrame:
    """Packs (order_key, ids) into rows of ``capacity`` on ``ranks`` independent streams, each in the order of
    ``order_key``. A stream is never held whole: its partition is read as it comes, with ``buffer`` sequences kept."""
    pad = special_id("<|bos|>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list[int | None] = [None]

        def streams() -> Iterator[tuple[int, list[int]]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        source = streams()
        ahead = next(source, None)
        schema = pa.schema([("rank", pa.int32()), ("row", pa.int64()), ("ids", pa.list_(pa.int32())), ("content", pa.int32()), ("cropped", pa.int32())])
        while ahead is not None:
            current[0] = ahead[0]

            def one() -> Iterator[list[int]]:
                nonlocal ahead
                while ahead is not None and ahead[0] == current[0]:
                    ids = ahead[1] or []
                    ahead = next(source, None)
                    yield ids

            rows: list[tuple] = []
            for i, (ids, content, cropped) in enumerate(pack_rows(one(), capacity, buffer, crop, pad, cut_long)):
                rows.append((current[0], i, ids, content, cropped))
                if len(rows) == 512:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)

    ranked = df.withColumn("rank", F.pmod(F.crc32(F.col(order).cast("binary")), F.lit(ranks)).cast("int"))
    parts = ranked.repartition(ranks, "rank").sortWithinPartitions("rank", order).select("rank", "ids")
    return parts.mapInArrow(run, _PACKED)


def calculator(expressions: Column) -> Column:
    """Value of an expression of digits and + - * / ( ), or of a ``.count(...)`` on a quoted text; null for all else.
    Parsed, never evaluated as code; powers and very long expressions are refused."""
    import ast
    import operator

    ops: dict[type, Callable] = {
        ast.Add: operator.add, ast.Sub: operator.sub, ast.Mult: operator.mul, ast.Div: operator.truediv,
        ast.FloorDiv: operator.floordiv, ast.USub: operator.neg, ast.UAdd: operator.pos,
    }

    def value(node: ast.AST):
        if isinstance(node, ast.Expression):
            return value(node.body)
        if isinstance(node, ast.Constant) and isinstance(node.value, (int, float)):
            return node.value
        if isinstance(node, ast.BinOp) and type(node.op) in ops:
            return ops[type(node.op)](value(node.left), value(node.right))
        if isinstance(node, ast.UnaryOp) and type(node.op) in ops:
            return ops[type(node.op)](value(node.operand))
        raise ValueError

    def counted(node: ast.AST):
        call = node.body
        if isinstance(call, ast.Call) and isinstance(call.func, ast.Attribute) and call.func.attr == "count" and len(call.args) == 1:
            text, part = call.func.value, call.args[0]
            if isinstance(text, ast.Constant) and isinstance(text.value, str) and isinstance(part, ast.Constant):
                return text.value.count(part.value)
        raise ValueError

    def one(expression: str | None) -> str | None:
        if expression is None or len(expression) > 1000:
            return None
        plain = expression.replace(",", "") if "count" not in expression else expression
        try:
            tree = ast.parse(plain.strip(), mode="eval")
            if set(plain) <= set("0123456789*+-/.() ") and "**" not in plain:
                return str(value(tree))
            return str(counted(tree)) if ".count(" in plain else None
        except (ValueError, SyntaxError, ZeroDivisionError, OverflowError, TypeError, RecursionError, MemoryError):
            return None

    return F.pandas_udf(lambda s: pd.Series([one(x) for x in s], dtype=object), "string")(expressions)


def encode_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a pretoken: of all neighbouring symbols those whose joint token was learned first are joined, until none
    can be; of equal ones the first. Symbols are linked and joints wait in a queue, so that time is O(n log n)."""
    n = len(piece)
    right = list(range(1, n + 1))
    left = list(range(-1, n - 1))
    text: list[bytes | None] = [piece[i : i + 1] for i in range(n)]

    def joint(i: int) -> tuple[int, int, bytes] | None:
        j = right[i] if i >= 0 else n
        if j >= n:
            return None
        both = text[i] + text[j]
        return (ranks[both], i, both) if both in ranks else None

    waiting = [x for i in range(n) if (x := joint(i))]
    heapq.heapify(waiting)
    while waiting:
        _, i, both = heapq.heappop(waiting)
        j = right[i]
        # a symbol that was joined meanwhile makes another text, or none
        if text[i] is None or j >= n or text[i] + text[j] != both:
            continue
        text[i], text[j] = both, None
        right[i] = right[j]
        if right[i] < n:
            left[right[i]] = i
        for k in (i, left[i]):
            if x := joint(k):
                heapq.heappush(waiting, x)
    return [ranks[t] for t in text if t is not None]


def encode(
    df: DataFrame,
    text: str,
    vocabulary: DataFrame,
    out: str = "ids",
    most_tokens: int = 1 << 18,
    prepend: str | int | None = None,
    append: str | int | None = None,
) -> DataFrame:
    """``df`` with the ids of ``text`` under (token_id, token); specials in a text are ordinary text, null gives null.
    ``prepend`` and ``append`` are ids, or names of specials, put before and after the ids of each text.

    The vocabulary is a bounded table (refused beyond ``most_tokens``) and travels with the task; pretokens are cut by
    the engine and encoded once each while a worker remembers them.
    """
    rows = vocabulary.select("token_id", "token").limit(most_tokens + 1).collect()
    if len(rows) > most_tokens:
        raise ValueError(f"more than {most_tokens} tokens")
    special = {s.encode() for s in SPECIALS}
    ranks = {bytes(r.token): r.token_id for r in rows if bytes(r.token) not in special}
    named = {bytes(r.token).decode(): r.token_id for r in rows if bytes(r.token) in special}
    ends = [None if e is None else F.array(F.lit(named[e] if isinstance(e, str) else e)) for e in (prepend, append)]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kept: dict[str, list[int]] = {}
        for batch in batches:
            found = []
            for pieces in batch:
                ids: list[int] | None = None if pieces is None else []
                for piece in pieces if pieces is not None else ():
                    if piece not in kept:
                        if len(kept) > 1 << 17:
                            kept.clear()
                        kept[piece] = encode_piece(piece.encode(), ranks)
                    ids += kept[piece]
                found.append(ids)
            yield pd.Series(found, dtype=object)

    ids = F.pandas_udf(run, "array<int>")(pretokens(F.col(text)))
    return df.withColumn(out, F.concat(*[x for x in (ends[0], ids, ends[1]) if x is not None]))


def decode(df: DataFrame, ids: str, vocabulary: DataFrame, out: str = "decoded", most_tokens: int = 1 << 18) -> DataFrame:
    """``df`` with the text of ``ids``: the tokens' bytes one after the other, broken parts as U+FFFD."""
    rows = vocabulary.select("token_id", F.hex("token").alias("h")).orderBy("token_id").limit(most_tokens + 1).collect()
    if len(rows) > most_tokens:
        raise ValueError(f"more than {most_tokens} tokens")
    table = F.array(*[F.lit(r.h) for r in rows]) if len(rows) <= 1024 else F.from_json(F.lit("[" + ",".join(f'"{r.h}"' for r in rows) + "]"), "array<string>")
    joined = F.array_join(F.transform(ids, lambda i: F.get(table, i)), "")
    return df.withColumn(out, F.make_valid_utf8(F.unhex(joined).cast("string")))
