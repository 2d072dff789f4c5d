"""A decision tree grown in SQL, level by level, to check the fitted model against.

The rules that results depend on: categories are put in order by the late rows they hold, ties by
number; bounds lie halfway between neighbouring values of the whole training set; of equal gains
the first feature and its first cut win; a node without a gain above zero is a leaf, as are those
at the depth limit; a tie of labels means on time; a node whose leaves all agree is a leaf.
"""

FEATURES = (
    "AirlineIndex AverageAirlineDelayBucketed OriginStateIndex DestinationStateIndex "
    "TimeSlotIndex Month DayOfWeek DistanceBucketed OriginLatitudeArea OriginLongitudeArea "
    "OriginAirportIndex AverageTaxiOutBucketed DestinationLatitudeArea DestinationLongitudeArea"
).split()
NUMBERS = [f for f in FEATURES if not f.endswith(("Index", "Bucketed"))]
CATEGORIES = "Airline TimeSlot OriginState DestinationState OriginAirport".split()
DEPTH = 10


def _gini(on_time, late):
    total = f"({on_time} + {late})"
    return (
        f"(1.0 - ({on_time} / {total}) * ({on_time} / {total})"
        f" - ({late} / {total}) * ({late} / {total}))"
    )


def _encoded():
    index = "\nUNION ALL ".join(
        f"""SELECT '{c}' AS "column", "{c}" AS "value", count(*) AS n
            FROM dealt WHERE "set" = 'Train' GROUP BY 2"""
        for c in CATEGORIES
    )
    joins = "\n".join(
        f"""LEFT JOIN train_index i{c} ON i{c}."column" = '{c}' AND i{c}."value" = d."{c}" """
        for c in CATEGORIES
    )
    indexed = {
        f"{c}Index": f"""coalesce(i{c}."index",
            (SELECT count(*) FROM train_index WHERE "column" = '{c}'))"""
        for c in CATEGORIES
    }
    buckets = {
        "AverageAirlineDelayBucketed": 'least(floor(("AverageAirlineDelay" + 1) / 3), 5)',
        "DistanceBucketed": 'least(floor("Distance" / 200), 14)',
        "AverageTaxiOutBucketed": 'least(floor("AverageTaxiOut" / 5), 5)',
    }
    columns = ", ".join(
        f'cast({indexed.get(f) or buckets.get(f) or chr(34) + f + chr(34)} AS double) AS "{f}"'
        for f in FEATURES
    )
    return {
        "dealt": """
            SELECT *, row_number() OVER () AS id,
                   CASE WHEN turn <= n * 70 // 100 + (pct < n * 70 % 100)::int
                        THEN 'Train' ELSE 'Test' END AS "set"
            FROM hashed""",
        "train_index": f"""
            SELECT "column", "value",
                   row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value") - 1
                       AS "index"
            FROM ({index})""",
        "encoded": f"""
            SELECT id, "set", "Delay" AS late, {columns} FROM dealt d {joins}""",
        "long": f"""
            UNPIVOT (SELECT id, "set", late, {", ".join(f'"{f}"' for f in FEATURES)} FROM encoded)
            ON {", ".join(f'"{f}"' for f in FEATURES)} INTO NAME feature VALUE v""",
        "features_in_order": "SELECT * FROM (VALUES {}) AS t(feature, place, number)".format(
            ", ".join(f"('{f}', {i}, {f in NUMBERS})" for i, f in enumerate(FEATURES))
        ),
        "bounds": """
            SELECT feature, row_number() OVER (PARTITION BY feature ORDER BY v) AS cut,
                   (v + next) / 2 AS bound
            FROM (SELECT feature, v, lead(v) OVER (PARTITION BY feature ORDER BY v) AS next
                  FROM (SELECT DISTINCT feature, v FROM long JOIN features_in_order USING (feature)
                        WHERE number AND "set" = 'Train'))
            WHERE next IS NOT NULL""",
        "at0": "SELECT id, 1::bigint AS node, true AS open FROM encoded",
    }


def _level(d):
    """Statistics, best cuts and the rows' nodes one level further down."""
    left, right = ("l0", "l1"), ("t0 - l0", "t1 - l1")
    share = "((l0 + l1) / (t0 + t1))", "((t0 - l0 + t1 - l1) / (t0 + t1))"
    gain = (
        f"{_gini('t0', 't1')} - {share[0]} * {_gini(*left)}"
        f" - {share[1]} * {_gini('(' + right[0] + ')', '(' + right[1] + ')')}"
    )
    return {
        f"seen{d}": f"""
            SELECT node, feature, v, sum(1 - late)::double AS c0, sum(late)::double AS c1
            FROM long JOIN at{d} USING (id) WHERE open AND "set" = 'Train' GROUP BY ALL""",
        f"total{d}": f"""
            SELECT node, sum(c0) AS t0, sum(c1) AS t1 FROM seen{d}
            WHERE feature = '{FEATURES[0]}' GROUP BY node""",
        f"order{d}": f"""
            SELECT node, feature, v, row_number() OVER w AS cut, sum(c0) OVER w AS l0,
                   sum(c1) OVER w AS l1
            FROM seen{d} JOIN features_in_order USING (feature) WHERE NOT number
            WINDOW w AS (PARTITION BY node, feature ORDER BY c1, v ROWS UNBOUNDED PRECEDING)""",
        f"cuts{d}": f"""
            SELECT node, feature, cut, NULL::double AS bound, l0, l1 FROM order{d}
            UNION ALL
            SELECT node, feature, cut, bound, coalesce(sum(c0) FILTER (v <= bound), 0),
                   coalesce(sum(c1) FILTER (v <= bound), 0)
            FROM seen{d} JOIN bounds USING (feature) GROUP BY node, feature, cut, bound""",
        f"best{d}": f"""
            SELECT node, feature, cut, bound, gain
            FROM (SELECT node, feature, place, cut, bound, {gain} AS gain
                  FROM cuts{d} JOIN total{d} USING (node) JOIN features_in_order USING (feature)
                  WHERE l0 + l1 > 0 AND t0 + t1 > l0 + l1)
            QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, cut) = 1""",
        f"split{d}": f"SELECT * FROM best{d} WHERE gain > 0",
        f"left{d}": f"""
            SELECT node, feature, v FROM order{d} o JOIN split{d} s USING (node, feature)
            WHERE o.cut <= s.cut""",
        f"at{d + 1}": f"""
            SELECT a.id, CASE WHEN s.node IS NULL THEN a.node
                              WHEN x.v <= s.bound OR l.v IS NOT NULL THEN 2 * a.node
                              ELSE 2 * a.node + 1 END AS node,
                   s.node IS NOT NULL AS open
            FROM at{d} a LEFT JOIN split{d} s ON a.open AND a.node = s.node
            LEFT JOIN long x ON x.id = a.id AND x.feature = s.feature
            LEFT JOIN left{d} l ON l.node = s.node AND l.feature = s.feature AND l.v = x.v""",
    }


def views():
    """The views, by name, upon one of the features with their hash."""
    found = _encoded()
    for d in range(DEPTH):
        found.update(_level(d))
    found["leaves"] = f"""
        SELECT node, count(*) FILTER (late = 0) AS on_time, count(*) FILTER (late = 1) AS late,
               (count(*) FILTER (late = 1) > count(*) FILTER (late = 0))::double AS prediction
        FROM at{DEPTH} JOIN encoded USING (id) WHERE "set" = 'Train' GROUP BY node"""
    found["guessed"] = f"""
        SELECT "set", prediction, encoded.late
        FROM at{DEPTH} JOIN leaves USING (node) JOIN encoded USING (id)"""
    return found


METRICS = """
SELECT "set", (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / nullif(tp + fp, 0) AS "precision",
       tp / nullif(tp + fn, 0) AS recall,
       CASE WHEN tp + fn = 0 THEN 0 WHEN fp + tn = 0 THEN 1
            ELSE (tp / (tp + fn) + tn / (fp + tn)) / 2 END::double AS auc
FROM (SELECT "set", count(*) FILTER (prediction = 1 AND late = 1) AS tp,
             count(*) FILTER (prediction = 1 AND late = 0) AS fp,
             count(*) FILTER (prediction = 0 AND late = 1) AS fn,
             count(*) FILTER (prediction = 0 AND late = 0) AS tn
      FROM guessed GROUP BY "set")
"""

REPORT = f"""
SELECT CASE "set" WHEN 'Train' THEN 0 ELSE 100 END + line_no AS line_no,
       CASE line_no WHEN 0 THEN '' WHEN 1 THEN 'Accuracy (' || "set" || '): ' || accuracy
                    WHEN 2 THEN 'Precision (' || "set" || '): ' || coalesce("precision"::varchar, 'NaN')
                    WHEN 3 THEN 'Recall (' || "set" || '):  ' || coalesce(recall::varchar, 'NaN')
                    ELSE 'Area under ROC curve (' || "set" || '): ' || auc END AS line
FROM ({METRICS}), (SELECT unnest([0, 1, 2, 3, 4]) AS line_no)
"""


def nodes():
    """The nodes of the tree; those below a node whose leaves agree are left out."""
    splits = "\nUNION ALL ".join(
        f"""SELECT s.node, s.feature, s.bound, s.gain,
                   (SELECT string_agg(l.v::bigint, ',' ORDER BY l.v) FROM left{d} l
                    WHERE l.node = s.node AND s.bound IS NULL) AS categories
            FROM split{d} s"""
        for d in range(DEPTH)
    )
    return f"""
        , above AS (
            SELECT node >> up AS node, on_time, late, prediction
            FROM leaves, (SELECT unnest(range(0, {DEPTH + 1})) AS up) WHERE node >> up > 0
        ), all_nodes AS (
            SELECT node, sum(on_time)::double AS on_time, sum(late)::double AS late,
                   max(prediction) AS prediction, min(prediction) < max(prediction) AS mixed
            FROM above GROUP BY node
        ), all_splits AS ({splits})
        SELECT a.node, floor(log2(a.node))::int AS depth,
               CASE WHEN a.mixed THEN s.feature END AS feature,
               CASE WHEN a.mixed THEN s.bound END AS bound,
               CASE WHEN a.mixed THEN s.categories END AS categories,
               CASE WHEN a.mixed THEN s.gain END AS gain,
               a.on_time, a.late,
               CASE WHEN a.mixed THEN (a.late > a.on_time)::double ELSE a.prediction END
                   AS prediction
        FROM all_nodes a LEFT JOIN all_splits s USING (node)
        LEFT JOIN all_nodes p ON p.node = a.node >> 1
        WHERE a.node = 1 OR p.mixed"""
