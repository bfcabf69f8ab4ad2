"""Chat formatting as a prefix tree.

A turn is formatted as ``<|im_start|>role`` line feed ``text<|im_end|>`` line feed. The two
marks are token ids of their own, beyond the vocabulary of a byte-level BPE; everything
else is ordinary text. So that the formatted text can be parsed too, a ``|`` after ``<``
and any backslashes gets one more backslash before it, and in a role, backslashes and line
feeds are written as two characters.

Conversations that begin with the same turns share them: a node is a turn after all turns
before it, named by a chain of hashes (its key). Each conversation has a number that is a
hash of its id, and a node belongs to the least number among the conversations that pass
through it. What a conversation owns is the end of its turns, a branch, which hangs on a
node of another branch; numbers are random, so that the branches above one are about the
logarithm of the conversations in number, however long these are. In depth-first order a
branch's turns follow one another, then come the branches that hang on them, the deepest
first. The tree has a row a node, in that order: start and finish of its tokens,
subtree_finish, position (of its first token, counted from the tree's root), spans (the
intervals that its tokens may attend to, one a branch above and the last, up to its own
finish, causally), its ids, and loss_from and loss_to, its ids under the loss mask (an
assistant's text). Paths name the nodes of each conversation.

There is a row a turn throughout, and no list longer than the branches above one: the only
step that takes a conversation's turns together reads them one after another, as the chain
of hashes and the digests need. Sums along a branch and among the branches that hang on one
node are made of ranges, and looking up a node or branch that many rows name is salted.

Defined results: null role or text counts as empty. Rows of a conversation are ordered by
turn (null first), role and text; repeated rows are turns of their own. A null conv_id is
a conversation like any other. Other columns are dropped. No conversations, no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_path, narrow_batches, new_path, read_table, salt_of

MODEL = "byte_bpe_50k.tiktoken"
START_ID, END_ID = 50256, 50257
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
SALTS = 32
_OPEN = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@functools.cache
def encoding(path: str | None = None) -> tiktoken.Encoding:
    with open(path or public_tokenizers.path(MODEL), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("chat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode_turn(role: str, text: str) -> tuple[list[int], int, int]:
    """Ids of a turn, and where its text's ids begin and end."""
    encode = encoding().encode_ordinary
    head = [START_ID, *encode(escape_role(role) + "\n")]
    body = encode(escape(text))
    return [*head, *body, END_ID, *encode("\n")], len(head), len(head) + len(body)


class Tree(NamedTuple):
    nodes: DataFrame  # key, depth, start, finish, subtree_finish, position, spans, ids, loss_from, loss_to
    paths: DataFrame  # conv_id, owner (its number), depth, key


def lookup(left: DataFrame, right: DataFrame, on: list[str], salt: str) -> DataFrame:
    """``left`` with the columns of ``right``, which has one row for each ``on``, or nulls.
    Rows that name the same are dealt over ``SALTS`` tasks by ``salt``."""
    salted = left.withColumn("salt", salt_of(SALTS, salt))
    met = salted.select(*on, "salt").distinct().join(right, on)
    return salted.join(met, [*on, "salt"], "left").drop("salt")


def chained(rows: DataFrame) -> DataFrame:
    """(conv_id, owner, depth, above, key, role, text): turns with their nodes' keys and those above."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    number = F.unhex(F.md5(F.coalesce(F.concat(F.lit("id "), F.col("conv_id").cast("string")), F.lit("null"))))
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    said = rows.select("conv_id", number.alias("owner"), F.col("turn").cast("long").alias("turn"), *text)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, key, depth = None, b"", 0
        for batch in batches:
            depths, aboves, keys = [], [], []
            for owner, role, text in zip(*(batch.column(c).to_pylist() for c in ("owner", "role", "text")), strict=True):
                if owner != last:
                    last, key, depth = owner, b"", 0
                depths.append(depth)
                aboves.append(key)
                key = hashlib.blake2b(b"%b%d\n%b" % (key, len(role), f"{role}{text}".encode()), digest_size=16).digest()
                keys.append(key)
                depth += 1
            made = [pa.array(depths, pa.int32()), pa.array(aboves, pa.binary()), pa.array(keys, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("owner"), *made, batch.column("role"), batch.column("text")],
                names=["conv_id", "owner", "depth", "above", "key", "role", "text"],
            )

    in_order = said.repartition("owner").sortWithinPartitions("owner", "turn", "role", "text").drop("turn")
    return in_order.mapInArrow(chain, f"conv_id {conv_type}, owner binary, depth int, above binary, key binary, role string, text string")


def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roles = batch.column("role").to_pylist()
        found = [encode_turn(role, text) for role, text in zip(roles, batch.column("text").to_pylist(), strict=True)]
        loss = [role == LOSS_ROLE for role in roles]
        made = [
            pa.array([len(ids) for ids, _, _ in found], pa.int64()),
            pa.array([ids for ids, _, _ in found], pa.list_(pa.int32())),
            pa.array([a if under else 0 for (_, a, _), under in zip(found, loss, strict=True)], pa.int32()),
            pa.array([b if under else 0 for (_, _, b), under in zip(found, loss, strict=True)], pa.int32()),
        ]
        columns = ["key", "above", "branch", "depth"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, columns), *made], names=[*columns, "n", "ids", "loss_from", "loss_to"])


def build_tree(rows: DataFrame) -> Tree:
    """The prefix tree of conversations (conv_id, turn, role, text), written to the shared folder."""
    spark = rows.sparkSession
    narrow_batches(spark)
    work, out = new_path(spark, "chat-work"), new_path(spark, "chat-tree")
    written = itertools.count()

    def kept(df: DataFrame, path: str | None = None) -> DataFrame:
        path = path or f"{work}/{next(written)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def running(rows: DataFrame, group: list[str], order: str, values: list[str]) -> DataFrame:
        """``rows`` with, for each value v, v_before: its sum over the group's rows before, in order."""
        dealt = kept(rows.repartitionByRange(*group, order).withColumn("part", F.spark_partition_id()))
        pieces = dealt.groupBy("part", *group).agg(*[F.sum(v).alias(v) for v in values])
        # A group has a row here for each range that it reaches into.
        earlier = Window.partitionBy(*group).orderBy("part")
        carried = pieces.select("part", *group, *[(F.sum(v).over(earlier) - F.col(v)).alias(f"{v}_carried") for v in values])
        inside = Window.partitionBy("part", *group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        sums = dealt.select("*", *[(F.sum(v).over(inside) - F.col(v)).alias(f"{v}_inside") for v in values])
        before = [(F.col(f"{v}_carried") + F.col(f"{v}_inside")).alias(f"{v}_before") for v in values]
        return sums.join(carried, ["part", *group]).select(*rows.columns, *before)

    turns = kept(chained(rows), f"{work}/turns")
    paths = kept(turns.select("conv_id", "owner", "depth", "key"), f"{out}/paths")
    least = turns.groupBy("key").agg(F.min("owner").alias("owner"))
    once = turns.join(least, ["key", "owner"]).select("key", "above", F.col("owner").alias("branch"), "depth", "role", "text")
    encoded = kept(once.mapInArrow(tokens, "key binary, above binary, branch binary, depth int, n long, ids array<int>, loss_from int, loss_to int"))
    drop_path(spark, f"{work}/turns")

    root = F.unhex(F.lit(""))
    first = encoded.groupBy("branch").agg(F.min("depth").alias("depth"), F.sum("n").alias("own"))
    hung = kept(first.join(encoded.select("branch", "depth", "above"), ["branch", "depth"]))
    owners = encoded.select(F.col("key").alias("above"), F.col("branch").alias("up"))
    branches = kept(lookup(hung, owners, ["above"], "branch").select("branch", F.coalesce("up", root).alias("up"), (F.col("depth") - 1).alias("attach"), "own"))

    # Tokens of a branch and of all below: each round adds those of the branches that are
    # 1, 2, 4, ... above, until no branch has one so far above it.
    state, climbs = branches.select("branch", "up", F.col("own").alias("total")), []
    while not (live := state.where(F.length("up") > 0)).isEmpty():
        climbs.append(live.select("branch", "up"))
        added = live.groupBy(F.col("up").alias("branch")).agg(F.sum("total").alias("added"))
        above = lookup(climbs[-1], state.select(F.col("branch").alias("up"), F.col("up").alias("next")), ["up"], "branch").drop("up")
        total = F.col("total") + F.coalesce("added", F.lit(0))
        state = kept(state.join(added, "branch", "left").join(above, "branch", "left").select("branch", F.coalesce("next", root).alias("up"), total.alias("total")))
    totals = state.select("branch", "total")

    children = running(branches.drop("own").join(totals, "branch"), ["up", "attach"], "branch", ["total"])
    weights = branches.join(totals, "branch").groupBy(F.col("up").alias("branch"), F.col("attach").alias("depth")).agg(F.sum("total").alias("hung"))
    sized = lookup(encoded.select("key", "branch", "depth", "n"), totals, ["branch"], "depth")
    weighted = sized.join(weights, ["branch", "depth"], "left").fillna(0, ["hung"])
    along = kept(running(weighted, ["branch"], "depth", ["n", "hung"]))

    # How far a branch's start is behind that of the one above, and how many tokens of that
    # one come before it; then the same of all above, in rounds as before.
    beyond, up_to = F.col("total") - F.col("hung_before") - F.col("hung"), F.col("n_before") + F.col("n")
    spots = along.select(F.col("branch").alias("up"), F.col("depth").alias("attach"), beyond.alias("beyond"), up_to.alias("up_to"))
    step = F.struct((F.coalesce("beyond", F.lit(0)) + F.col("total_before")).alias("offset"), F.coalesce("up_to", F.lit(0)).alias("up_to"))
    steps = kept(lookup(children, spots, ["up", "attach"], "branch").select("branch", F.array(step).alias("steps")))
    for climb in climbs:
        above = lookup(climb, steps.select(F.col("branch").alias("up"), F.col("steps").alias("more")), ["up"], "branch").drop("up")
        both = F.when(F.col("more").isNull(), F.col("steps")).otherwise(F.concat("steps", "more"))
        steps = kept(steps.join(above, "branch", "left").select("branch", both.alias("steps")))

    def summed(listed: Column, name: str) -> Column:
        return F.aggregate(listed, F.lit(0).cast("long"), lambda a, s: a + s[name])

    def span(start: Column, finish: Column) -> Column:
        return F.struct(start.alias("start"), finish.alias("finish"))

    down = F.reverse("steps")
    spans = F.transform(
        F.slice(down, F.lit(2), F.size(down)),
        lambda s, i: span(summed(F.slice(down, F.lit(1), i + 1), "offset"), summed(F.slice(down, F.lit(1), i + 1), "offset") + s["up_to"]),
    )
    starts = steps.select("branch", summed(F.col("steps"), "offset").alias("branch_start"), summed(F.col("steps"), "up_to").alias("branch_position"), spans.alias("above"))
    start = F.col("branch_start") + F.col("n_before")
    places = lookup(along, starts, ["branch"], "depth").select(
        "key", "depth", start.alias("start"), (start + F.col("n")).alias("finish"), (F.col("branch_start") + F.col("total") - F.col("hung_before")).alias("subtree_finish"),
        (F.col("branch_position") + F.col("n_before")).alias("position"), F.concat("above", F.array(span(F.col("branch_start"), start + F.col("n")))).alias("spans"),
    )
    nodes = places.join(encoded.select("key", "ids", "loss_from", "loss_to"), "key").repartitionByRange("start").sortWithinPartitions("start")
    nodes = kept(nodes, f"{out}/nodes")
    drop_path(spark, work)
    return Tree(nodes, paths)


def parse_turns(ids: list[int]) -> tuple[list[tuple[str, str]], int]:
    """(role, text) of each turn, and the number of formatted characters."""
    decode, turns, chars, at = encoding().decode_bytes, [], 0, 0
    while at < len(ids):
        end = ids.index(END_ID, at)
        shown = decode(ids[at + 1 : end]).decode()
        role, _, text = shown.partition("\n")
        turns.append((unescape_role(role), unescape(text)))
        at = end + 1
        while at < len(ids) and ids[at] != START_ID:
            at += 1
        chars += len(START) + len(shown) + len(END) + 1
    return turns, chars


def read_conversations(tree: Tree) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), from the tree's rows."""
    conv_type = tree.paths.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, now, conv_type = None, None, None

        def shown(done: list) -> pa.RecordBatch:
            rows = [(n, said.hexdigest(), learned, loss.hexdigest(), chars) for _, n, said, learned, loss, chars in done]
            ids = pa.array([d[0] for d in done], conv_type)
            return pa.RecordBatch.from_arrays([ids, *[pa.array([r[c] for r in rows], t) for c, t in enumerate(types)]], names=names)

        for batch in batches:
            done, conv_type = [], batch.schema.field("conv_id").type
            for conv_id, owner, ids, a, b in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "owner", "ids", "loss_from", "loss_to")), strict=True):
                if owner != last:
                    if now:
                        done.append(now)
                    last, now = owner, [conv_id, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns, chars = parse_turns(ids)
                for role, text in turns:
                    now[2].update(f"{role}\n{text}\n".encode())
                learned = unescape(encoding().decode_bytes(ids[a:b]).decode())
                now[1] += len(turns)
                now[3] += len(learned)
                now[4].update(learned.encode())
                now[5] += chars
            if done:
                yield shown(done)
        if now:
            yield shown([now])

    said = lookup(tree.paths, tree.nodes.select("key", "ids", "loss_from", "loss_to"), ["key"], "owner")
    in_order = said.repartition("owner").sortWithinPartitions("owner", "depth").select("conv_id", "owner", "ids", "loss_from", "loss_to")
    return in_order.mapInArrow(digest, f"conv_id {conv_type}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "<|im_end|><|im_start|>assistant ok"
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_conversations(build_tree(rows.unionByName(more)))


OP7_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(sum(24 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g'))
             + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g'))) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
