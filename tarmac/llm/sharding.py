"""Consistent-hash ring with virtual nodes and bounded loads.

A key hashes to a cell of the ring. The cell's owner is the first virtual node clockwise.
A shard takes no more rows than its bound; what arrives at a full shard goes on clockwise
to the next virtual node of a shard with room. With ``slack`` 0 the bounds add up to
the number of rows, so counts differ by one at most; with more slack fewer rows overflow and
fewer move when the shards change.

The ring has a fixed number of cells, so all decisions are made on one count per cell: a
bounded table. A row then needs only its number within its cell, found by a window
over one cell's rows. No shard, source or group of copies ever meets in one task: copies
differ in their key and lie all over the ring.
"""

from bisect import bisect_left

from pyspark.sql import Window
from pyspark.sql import functions as F

CELLS = 1 << 14
VIRTUAL_NODES = 64
SEGMENTS = "cell int, first long, last long, shard int, slot long"


def _mix(value):
    """A fixed 64-bit mix, so that virtual nodes lie evenly on the ring."""
    value = (value + 0x9E3779B97F4A7C15) % 2**64
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) % 2**64
    return value ^ (value >> 31)


def ring(shards, virtual_nodes=VIRTUAL_NODES, cells=CELLS):
    """Cells of the virtual nodes and their shards, clockwise."""
    nodes = sorted(
        (_mix(_mix(shard + 1) + node) % cells, _mix(node * shards + shard), shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )
    return [cell for cell, _, _ in nodes], [shard for _, _, shard in nodes]


def bounds(rows, shards, slack=0.0):
    """Most rows of each shard; they always hold all rows."""
    if slack:
        return [-int(-rows * (1 + slack) // shards)] * shards
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def segments(counts, shards, slack=0.0, virtual_nodes=VIRTUAL_NODES, cells=CELLS):
    """Split the rows of each cell into runs that go to one shard.

    ``counts`` maps cells to their rows. Returned are (cell, first, last, shard, slot):
    rows ``first`` to ``last`` of the cell, by number, get the shard's slots from ``slot`` on.
    """
    places, owners = ring(shards, virtual_nodes, cells)
    room = bounds(sum(counts.values()), shards, slack)
    taken = [0] * shards
    made = []

    def place(cell, first, last, at):
        for step in range(len(owners)):
            shard = owners[(at + step) % len(owners)]
            fits = min(last - first + 1, room[shard] - taken[shard])
            if fits > 0:
                made.append((cell, first, first + fits - 1, shard, taken[shard]))
                taken[shard] += fits
                first += fits
            if first > last:
                return

    for cell in sorted(counts):
        place(cell, 0, counts[cell] - 1, bisect_left(places, cell) % len(places))
    return made


def ring_cell(*key, cells=CELLS):
    return F.pmod(F.xxhash64(*key), F.lit(cells)).cast("int")


def shard_rows(docs, key="doc_id", text="text", shards=16, slack=0.0):
    """Place every row into a shard of the ring by its key.

    Returns the key, ``size`` (UTF-8 bytes of the text plus 1), ``text_crc32``, ``shard`` and
    ``slot``, numbered from 0 without gaps in each shard; other columns are left out, so
    their names cannot clash. A null text has no bytes. A null key is a key like any other.
    Rows with equal keys share a cell and are told apart by their texts; rows equal in
    everything get different slots. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(key),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        ring_cell(F.col(key)).alias("cell"),
    )
    counts = {
        row["cell"]: row["n"]
        for row in docs.select(ring_cell(F.col(key)).alias("cell"))
        .groupBy("cell")
        .agg(F.count("*").alias("n"))
        .collect()
    }
    plan = spark.createDataFrame(segments(counts, shards, slack), SEGMENTS)
    in_cell = Window.partitionBy("cell").orderBy(F.xxhash64(key), key, "text_crc32", "size")
    numbered = rows.withColumn("number", (F.row_number().over(in_cell) - 1).cast("long"))
    # At most one run for each cell and each time a shard fills up: some 16,400 rows.
    return numbered.join(
        F.broadcast(plan),
        (numbered["cell"] == plan["cell"]) & F.col("number").between(F.col("first"), F.col("last")),
    ).select(
        key,
        "size",
        "text_crc32",
        "shard",
        (F.col("slot") + F.col("number") - F.col("first")).alias("slot"),
    )
