"""Deal linked documents to shards by balanced label propagation.

Law "rows": the shards hold equally many documents, or one more. A label is a shard. Linked documents start with labels
dealt in turn; in each round every linked document counts the labels of its neighbours and, if another label has
more neighbours than its own, asks to move there. Only half of the documents, drawn anew by hash each round, may ask, so that pairs
do not just swap. Quotas keep the balance: moves from a to b are matched by moves from b to a, and beyond
that b takes no more linked documents than it has room for. Requests with the highest gain go first. Groups that fit a shard and are still split are then
moved whole where there is room (``gather``). Documents without links fill up
the shards at the end, to the exact count.

Copies of a text are linked as a star of stars: each to the first of its salted part, and those to the first of all. With about the
square root of all rows as the number of parts, no document has more than about twice that many neighbours, whatever the group.

Scale: every join and aggregation is keyed by document. Per round the driver sees a table of at most shards * shards * 64
counts. Labels and requests are written tables in the shared folder.

Edge cases: a NULL text has size 8, checksum 0 and no links; repeated rows are documents of their own; an empty table
gives an empty table; a group larger than a shard is split; extra columns are kept in ``row``.
"""

from math import isqrt

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import discard, prefix_sums, stored
from .graph import components

SHARDS = 24
ROUNDS = 12
GATHERS = 4
LEVELS, STEPS = 4, 16
BUCKET_BITS, NODE_BITS = 8, 6


def number_rows(docs, *columns):
    """A stored table of ``columns`` with ``node``, a number for each row."""
    return stored(docs.select(F.monotonically_increasing_id().alias("node"), *columns), "rows")


def equal_text_links(nodes, count, code="code"):
    """Links (a, b) among rows of one text, ``code`` being its digest; one or two for each copy."""
    parts = 1 << (isqrt(max(count - 1, 0))).bit_length()
    rows = nodes.where(F.col(code).isNotNull()).select("node", code, F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part"))
    near = rows.groupBy(code, "part").agg(F.min("node").alias("first"))
    far = near.groupBy(code).agg(F.min("first").alias("b"))
    inner = rows.join(near, [code, "part"]).where("node != first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    outer = near.join(far, code).where("first != b").select(F.col("first").alias("a"), "b")
    return inner.union(outer)


def _hash(col):
    return F.xxhash64(col)


def _order(df, groups, key, name):
    """Number the rows per group from 0, in the order of the first bits of a hash of ``key``, then of a hash of the node; so rows of one key,
    however many, are spread over ``1 << NODE_BITS`` buckets."""
    df = df.withColumns({"_hash": _hash(key), "_own": _hash("node")})
    first, second = F.shiftrightunsigned("_hash", 64 - BUCKET_BITS), F.shiftrightunsigned("_own", 64 - NODE_BITS)
    bucket = (F.shiftleft(first, NODE_BITS) + second).cast("int")
    return prefix_sums(df, groups, bucket, ["_hash", "_own", "node"], F.lit(1), name).drop("_hash", "_own")


def quotas(asked, room, shards):
    """How many moves of each pair (from, to) are granted: the mutual ones, and a fair part of the room left in ``to``."""
    granted, left = {}, dict(room)
    for (a, b), n in asked.items():
        granted[a, b] = min(n, asked.get((b, a), 0))
    for b in range(shards):
        more = {a: n - granted[a, b] for (a, to), n in sorted(asked.items()) if to == b and n > granted[a, b]}
        total, free = sum(more.values()), max(0, left[b])
        for a, n in more.items():
            granted[a, b] += n if total <= free else n * free // total
    return granted


def settle(held, room, moves):
    """Take back moves, the smallest first, while a shard would hold more than its room; the moves and the new counts.

    Moves are granted in whole bins, so the two directions of a pair may differ by part of a bin.
    """
    moves, held = dict(moves), dict(held)
    for (old, new), n in moves.items():
        held[old] -= n
        held[new] += n
    while full := [b for b in room if held[b] > room[b]]:
        pair = min((p for p in moves if p[1] == full[0] and moves[p]), key=lambda p: (moves[p], p))
        held[pair[0]] += moves[pair]
        held[pair[1]] -= moves[pair]
        moves[pair] = 0
    return moves, held


def _requests(both, labels, turn):
    """Documents whose neighbours mostly have another label: (node, old, new, bin); low bins have the higher gains."""
    theirs = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
    mine = labels.select("node", "label")
    votes = both.join(theirs, "other").groupBy("node", "theirs").agg(F.count("*").alias("votes"))
    tie = F.xxhash64("node", "theirs", F.lit(turn))
    best = votes.join(mine, "node").groupBy("node", "label").agg(
        F.max(F.struct("votes", tie.alias("tie"), "theirs")).alias("best"),
        F.coalesce(F.max(F.when(F.col("theirs") == F.col("label"), F.col("votes"))), F.lit(0)).alias("here"),
    )
    gain = F.col("best.votes") - F.col("here")
    draw = F.xxhash64("node", F.lit(-1 - turn))
    level = F.greatest(F.lit(0), LEVELS - 1 - F.floor(F.log2(gain)))
    return best.where((F.col("best.theirs") != F.col("label")) & (gain > 0) & (F.pmod(draw, F.lit(2)) == 0)).select(
        "node", F.col("label").alias("old"), F.col("best.theirs").alias("new"),
        (level * STEPS + F.pmod(F.shiftright(draw, 8), F.lit(STEPS))).cast("int").alias("bin"),
    )


def propagate(nodes, links, count, shards=SHARDS, rounds=ROUNDS):
    """Labels of the linked documents (node, label), stored, and how many each shard has."""
    both = stored(links.union(links.select("b", "a")).toDF("node", "other").distinct(), "links")
    linked = both.select("node").distinct()
    labels = stored(_order(linked, [], "node", "rank").select("node", (F.col("rank") % shards).cast("int").alias("label")), "labels")
    held = dict.fromkeys(range(shards), 0) | {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    room = {b: count // shards + (b < count % shards) for b in range(shards)}
    schema = StructType([StructField(c, IntegerType()) for c in ("old", "new", "last")])
    linked_count, quiet = sum(held.values()), 0
    for turn in range(rounds if linked_count else 0):
        requests = stored(_requests(both, labels, turn), "requests")
        bins = {}
        for row in requests.groupBy("old", "new", "bin").count().collect():
            bins.setdefault((row.old, row.new), {})[row.bin] = row["count"]
        granted = quotas({k: sum(v.values()) for k, v in bins.items()}, {b: room[b] - held[b] for b in room}, shards)
        cuts = []
        for (old, new), counts in bins.items():
            last, done = -1, 0
            for b in sorted(counts):
                if done + counts[b] > granted[old, new]:
                    break
                last, done = b, done + counts[b]
            cuts.append((old, new, last))
            bins[old, new] = done
        done, held = settle(held, room, bins)
        cuts = [(old, new, last) for old, new, last in cuts if done[old, new]]
        moved = sum(done.values())
        quiet = 0 if moved * 500 > linked_count else quiet + 1
        if moved:
            allowed = F.broadcast(both.sparkSession.createDataFrame(cuts, schema))  # at most shards * shards rows
            accepted = requests.join(allowed, ["old", "new"]).where("bin <= last").select("node", "new")
            before = labels
            labels = stored(labels.join(accepted, "node", "left").select("node", F.coalesce("new", "label").alias("label")), "labels")
            discard(before)
        discard(requests)
        if quiet == 2:
            break
    return labels, held


def gather(links, labels, held, room, turns=GATHERS):
    """Bring together, as far as there is room, the linked groups that fit a shard and still lie in several: the labels and how many each shard has.

    A group first asks for the shard that has most of it, then for one of those with the most room. Requests are granted in the order of a hash while
    what comes in fits; what goes out makes room for the next turn.
    """
    groups = components(links.toDF("u", "v")).toDF("node", "root")
    placed, least = stored(labels.join(groups, "node").select("node", "label", "root"), "grouped"), min(room.values())
    for turn in range(turns):
        free = [room[b] - held[b] for b in sorted(room)]
        parts = placed.groupBy("root", "label").agg(F.count("*").alias("n"))
        whole = parts.groupBy("root").agg(  # a row per shard at most
            F.sum("n").alias("total"), F.max(F.struct("n", (-F.col("label")).alias("minus"))).alias("most"),
            F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("own"),
        )
        split = whole.where((F.col("total") > F.col("most.n")) & (F.col("total") <= least))
        roomy = F.array(*[F.lit(b) for b in sorted(room, key=lambda b: (-free[b], b))[:4]])
        target = -F.col("most.minus") if turn == 0 else F.element_at(roomy, (F.pmod(F.xxhash64("root", F.lit(turn)), F.size(roomy)) + 1).cast("int"))
        wishes = split.withColumn("target", target).withColumn("needs", F.col("total") - F.coalesce(F.try_element_at("own", "target"), F.lit(0)))
        wishes = wishes.select("root", "target", "needs", _hash("root").alias("_hash"))
        bucket = F.shiftrightunsigned("_hash", 64 - BUCKET_BITS).cast("int")
        wishes = prefix_sums(wishes, ["target"], bucket, ["_hash", "root"], F.col("needs"), "before")
        fits = F.col("before") + F.col("needs") <= F.element_at(F.array(*[F.lit(n) for n in free]), F.col("target") + 1)
        granted = stored(wishes.select("root", "target", fits.alias("fits")), "granted")
        asked = granted.agg(F.count("*").alias("all"), F.count_if("fits").alias("fit")).first()
        if not asked["all"]:
            break
        if asked.fit:
            moves, before = granted.where("fits").select("root", "target"), placed
            placed = stored(placed.join(moves, "root", "left").select("node", F.coalesce("target", "label").cast("int").alias("label"), "root"), "grouped")
            held = dict.fromkeys(room, 0) | {r.label: r["count"] for r in placed.groupBy("label").count().collect()}
            discard(before)
        discard(granted)
    return placed.select("node", "label"), held


def balanced_shards(nodes, links, shards=SHARDS, rounds=ROUNDS, key="doc_id"):
    """All columns of ``nodes`` with their shard and their slot in it, from 0 without gaps."""
    count = nodes.count()
    labels, held = propagate(nodes, links, count, shards, rounds)
    if sum(held.values()):
        labels, held = gather(links, labels, held, {b: count // shards + (b < count % shards) for b in range(shards)})
    filled, ends = 0, []
    for b in range(shards):
        filled += count // shards + (b < count % shards) - held[b]
        ends.append(filled)
    keys = nodes.select("node", F.col(key).alias("_key"))
    free = _order(keys.join(labels, "node", "left_anti"), [], "_key", "rank")
    place = F.size(F.filter(F.array(*[F.lit(e) for e in ends]), lambda e: e <= F.col("rank")))
    placed = labels.join(keys, "node").select("node", "_key", F.col("label").alias("shard")).union(free.select("node", "_key", place.cast("int").alias("shard")))
    placed = _order(placed, ["shard"], "_key", "slot").select("node", "shard", F.col("slot").cast("long").alias("slot"))
    return nodes.join(placed, "node")
