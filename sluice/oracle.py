"""The SQL each query is checked against, written for DuckDB over the same tables."""

from __future__ import annotations

from .catalog import (
    BAD_TEXT,
    EVENT_BATCH,
    EVENT_SHARD_ROWS,
    LBFGS_ITERATIONS,
    LBFGS_MEMORY,
    LINE_FEATURES,
    NETWORKS,
    PLAN_BATCH,
    PLAN_FILES,
    PLAN_WORKERS,
    PLATEAU,
    RATE,
    REPORT_CLASSES,
    SCORE_LAYER,
    TRAIN_EPOCHS,
    TRAIN_RATE,
    TRAIN_RULE,
    fixed_weights,
)
from .plans.lbfgs import GAIN, STEPS
from .plans.networks import unpack


def r(expression: str, digits: int = 6) -> str:
    half = 0.5 * 10.0**-digits
    return (
        f"CASE WHEN abs({expression}) < {half!r} THEN 0.0 "
        f"ELSE round(CAST({expression} AS DOUBLE), {digits}) END"
    )


def bucket(key: str, buckets: int | str = 10000) -> str:
    return f"(CAST('0x' || substr(md5('42:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % {buckets})"


def split_name(key: str) -> str:
    b = bucket(key)
    return f"CASE WHEN {b} < 7000 THEN 'train' WHEN {b} < 8500 THEN 'val' ELSE 'test' END"


def index_table(source: str, column: str, where: str = "true") -> str:
    """Value, count, index by frequency, balanced weight."""
    return (
        f"SELECT {column} AS value, count(*) AS n, "
        f"row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS idx, "
        f"CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)) AS weight "
        f"FROM {source} WHERE {column} IS NOT NULL AND {where} GROUP BY {column}"
    )


LINE_X = (
    "l_quantity / 50.0 AS x0, l_extendedprice / 100000.0 AS x1, "
    "l_discount * 10.0 AS x2, l_tax * 10.0 AS x3"
)

LINE_ROWS = f"""
labels AS ({index_table('lineitem', 'l_returnflag')}),
line_rows AS (
  SELECT l_orderkey, l_linenumber, {LINE_X}, labels.idx AS label, labels.weight AS weight
  FROM lineitem JOIN labels ON l_returnflag = labels.value)"""

EVENT_ROWS = f"""
labels AS ({index_table('events', 'event_type')}),
event_rows AS (
  SELECT event_id, events.value / 100.0 AS x0, user_id / 100.0 AS x1, length(props) / 10.0 AS x2,
         labels.idx AS label, labels.weight AS weight
  FROM events JOIN labels ON event_type = labels.value)"""

LINE_PAIRS = """
pairs AS (
  SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS label,
         CAST((l_linenumber + CAST(floor(l_quantity) AS INTEGER)) % 4 AS BIGINT) AS prediction
  FROM lineitem),
counts AS (SELECT label, prediction, count(*) AS n FROM pairs GROUP BY ALL)"""

MATRIX = """
seen AS (SELECT label AS c FROM counts UNION SELECT prediction FROM counts),
matrix AS (
  SELECT a.c AS label, b.c AS prediction, CAST(coalesce(max(n), 0) AS BIGINT) AS n
  FROM seen a CROSS JOIN seen b
  LEFT JOIN counts ON counts.label = a.c AND counts.prediction = b.c GROUP BY ALL)"""

SCORE_SQL = ", ".join(
    f"list_dot_product(CAST(embedding AS DOUBLE[]), [{', '.join(repr(float(w)) for w in row)}]::DOUBLE[])"
    for row in SCORE_LAYER
)

EMBEDDING = f"""
labels AS ({index_table('embeddings', 'label')}),
scores AS (
  SELECT vec_id, embeddings.label AS label, labels.weight AS weight,
         [{SCORE_SQL}] AS z
  FROM embeddings JOIN labels ON embeddings.label = labels.value),
losses AS (
  SELECT *, ln(list_sum(list_transform(z, lambda v: exp(v)))) - z[label + 1] AS ce,
         list_position(z, list_max(z)) - 1 AS prediction
  FROM scores)"""

HISTORY = """
history AS (
  SELECT event_type AS run_id,
         CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS BIGINT) AS epoch,
         round(avg(value), 9) AS val_loss,
         round(avg(CASE WHEN value < 20.0 THEN 1.0 ELSE 0.0 END), 9) AS val_acc
  FROM events GROUP BY ALL)"""


def report_sql(ctes: str, classes: str) -> str:
    """Report from a CTE ``counts``; ``classes`` selects ``idx`` and ``name``."""
    def per_class(metric, value):
        return f"SELECT name AS class, '{metric}' AS metric, CAST({value} AS DOUBLE) AS value FROM rates"

    def overall(name, metric, value):
        return f"SELECT '{name}', '{metric}', CAST({value} AS DOUBLE) FROM rates"

    rows = [
        per_class("precision", "p"), per_class("recall", "rc"), per_class("f1-score", "f"),
        per_class("support", "support"),
        overall("accuracy", "accuracy", "sum(tp) / sum(support)"),
    ]
    for metric, column in (("precision", "p"), ("recall", "rc"), ("f1-score", "f")):
        rows.append(overall("macro avg", metric, f"avg({column})"))
        rows.append(overall("weighted avg", metric, f"sum({column} * support) / sum(support)"))
    rows += [overall(f"{k} avg", "support", "sum(support)") for k in ("macro", "weighted")]
    return f"""
WITH {ctes},
classes AS ({classes}),
sums AS (
  SELECT name,
    coalesce((SELECT sum(n) FROM counts WHERE label = idx AND prediction = idx), 0) AS tp,
    coalesce((SELECT sum(n) FROM counts WHERE label = idx), 0) AS support,
    coalesce((SELECT sum(n) FROM counts WHERE prediction = idx), 0) AS predicted
  FROM classes),
ratios AS (
  SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / predicted END AS p,
         CASE WHEN support = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / support END AS rc FROM sums),
rates AS (SELECT *, CASE WHEN p + rc = 0 THEN 0.0 ELSE 2 * p * rc / (p + rc) END AS f FROM ratios),
report AS ({' UNION ALL '.join(rows)})
SELECT class, metric, {r('value')} AS value FROM report"""


# --- networks as nested selects, one level per layer ---


def affine(inputs: list[str], weights, bias) -> list[str]:
    return [
        " + ".join([f"({float(b)!r})", *[f"({float(w)!r}) * {c}" for w, c in zip(row, inputs)]])
        for row, b in zip(weights, bias)
    ]


class Levels:
    """A chain of CTEs in which each level computes new columns from the level before."""

    def __init__(self, base: str, carried: list[str]):
        self.parts = [base]
        self.last = "line_rows"
        self.carried = carried

    def add(self, expressions: list[str], prefix: str, keep: list[str] = ()) -> list[str]:
        name = f"level{len(self.parts)}"
        names = [f"{prefix}{i}" for i in range(len(expressions))]
        columns = [*self.carried, *keep, *[f"{e} AS {n}" for e, n in zip(expressions, names)]]
        self.parts.append(f"{name} AS (SELECT {', '.join(columns)} FROM {self.last})")
        self.last = name
        return names

    def norm(self, inputs: list[str], weights, bias, prefix: str) -> list[str]:
        total = " + ".join(inputs)
        mean = self.add([f"({total}) / {len(inputs)}"], f"{prefix}m", inputs)[0]
        squares = " + ".join(f"({c} - {mean}) * ({c} - {mean})" for c in inputs)
        scale = self.add([f"sqrt(({squares}) / {len(inputs)} + 1e-5)"], f"{prefix}s", [*inputs, mean])[0]
        return self.add(
            [f"({c} - {mean}) / {scale} * ({float(w)!r}) + ({float(b)!r})"
             for c, w, b in zip(inputs, weights, bias)],
            prefix,
        )


def sigmoid(x: str) -> str:
    return f"(1.0 / (1.0 + exp(-({x}))))"


def network_sql(kind: str, carried: list[str]) -> tuple[str, list[str], str]:
    """CTEs ending in the class scores, their column names and the last CTE's name."""
    net = NETWORKS[kind]
    p = unpack(net, fixed_weights(net))
    chain = Levels(LINE_ROWS, carried)
    x = ["x0", "x1", "x2", "x3"]
    if kind == "transformer":
        x = chain.add(
            [f"{e} + ({float(v)!r})" for e, v in zip(
                affine(x, p["input_projection.weight"], p["input_projection.bias"]),
                p["positional_encoding"])], "e")
        for i in range(net.num_layers):
            at = f"layers.{i}"

            def dense(name, inputs):
                return affine(inputs, p[f"{at}.{name}.weight"], p[f"{at}.{name}.bias"])

            def norm(name, inputs, prefix):
                return chain.norm(inputs, p[f"{at}.{name}.weight"], p[f"{at}.{name}.bias"], prefix)

            v = chain.add(dense("value", x), f"v{i}_", x)
            y = chain.add([f"{c} + {e}" for c, e in zip(x, dense("out_proj", v))], f"a{i}_")
            y = norm("norm1", y, f"n{i}_")
            f = chain.add([f"greatest({e}, 0.0)" for e in dense("linear1", y)], f"f{i}_", y)
            x = chain.add([f"{c} + {e}" for c, e in zip(y, dense("linear2", f))], f"b{i}_")
            x = norm("norm2", x, f"o{i}_")
        x = chain.norm(x, p["layer_norm.weight"], p["layer_norm.bias"], "ln")
        head = affine(x, p["classifier.weight"], p["classifier.bias"])
    else:
        for i in range(net.num_layers):
            w, bi, bh = (p[f"{kind}.{n}_l{i}"] for n in ("weight_ih", "bias_ih", "bias_hh"))
            h = net.hidden_size
            if kind == "rnn":
                x = chain.add([f"tanh({e})" for e in affine(x, w, bi + bh)], f"h{i}_")
                continue
            a = affine(x, w, bi)
            if kind == "lstm":
                g = chain.add([f"{e} + ({float(b)!r})" for e, b in zip(a, bh)], f"g{i}_")
                x = chain.add(
                    [f"{sigmoid(g[2 * h + j])} * tanh({sigmoid(g[j])} * tanh({g[h + j]}))"
                     for j in range(h)], f"h{i}_")
            else:
                g = chain.add(a, f"g{i}_")
                b = [f"({float(v)!r})" for v in bh]
                x = chain.add(
                    [f"(1.0 - {sigmoid(f'{g[h + j]} + {b[h + j]}')}) * tanh({g[2 * h + j]} + "
                     f"{sigmoid(f'{g[j]} + {b[j]}')} * {b[2 * h + j]})" for j in range(h)], f"h{i}_")
        if kind == "gru":
            x = chain.add(
                [f"greatest({e}, 0.0)" for e in affine(x, p["fc1.weight"], p["fc1.bias"])], "q")
            head = affine(x, p["fc2.weight"], p["fc2.bias"])
        else:
            head = affine(x, p["fc.weight"], p["fc.bias"])
    z = chain.add(head, "z")
    return ",\n".join(chain.parts), z, chain.last


PREDICTED = "CASE WHEN z0 >= z1 AND z0 >= z2 THEN 0 WHEN z1 >= z2 THEN 1 ELSE 2 END"


def score_sql(kind: str) -> str:
    ctes, z, last = network_sql(kind, ["l_orderkey", "l_linenumber"])
    shown = ", ".join(f"{r(c)} AS {c}" for c in z)
    return (
        f"WITH {ctes} SELECT l_orderkey, l_linenumber, {shown}, "
        f"CAST({PREDICTED} AS BIGINT) AS prediction FROM {last}"
    )


PARAMETERS = [f"w{k}_{j}" for k in range(3) for j in range(4)] + [f"b{k}" for k in range(3)]


def start_sql() -> str:
    """Parameters and zero moments as the columns of a one-row table p0."""
    p = unpack(NETWORKS["linear"], fixed_weights(NETWORKS["linear"]))
    start = [*p["fc.weight"].ravel(), *p["fc.bias"]]
    values = [f"CAST({float(v)!r} AS DOUBLE) AS {n}" for n, v in zip(PARAMETERS, start)]
    zeros = [f"CAST(0.0 AS DOUBLE) AS {m}_{n}" for n in PARAMETERS for m in "mv"]
    return f"p0 AS (SELECT {', '.join([*values, *zeros])})"


def forward_sql(name: str, rows: str, parameters: str) -> str:
    """Rows with exponentials of their scores, loss and whether the first best class is right."""
    z = [" + ".join([f"b{k}", *[f"w{k}_{j} * x{j}" for j in range(4)]]) for k in range(3)]
    exps = ", ".join(f"exp({e}) AS e{k}" for k, e in enumerate(z))
    return (
        f"{name} AS (SELECT *, -ln(list_extract([e0, e1, e2], label + 1) / (e0 + e1 + e2)) AS ce, "
        f"list_position([e0, e1, e2], greatest(e0, e1, e2)) - 1 = label AS hit "
        f"FROM (SELECT {rows}.*, {exps} FROM {rows} CROSS JOIN {parameters}))"
    )


def step_sql(t: int, rate: str, rest: str = "") -> list[str]:
    """CTEs of one AdamW step from p(t-1) and the rows z(t) to p(t); ``rest`` holds more sums."""
    slope = [
        f"weight * (e{k} / (e0 + e1 + e2) - CASE WHEN label = {k} THEN 1.0 ELSE 0.0 END)"
        for k in range(3)
    ]
    sums = [f"avg({slope[k]} * x{j}) AS g_w{k}_{j}" for k in range(3) for j in range(4)]
    sums += [f"avg({slope[k]}) AS g_b{k}" for k in range(3)]
    first = [f"0.9 * m_{n} + 0.1 * g_{n} AS m_{n}" for n in PARAMETERS]
    second = [f"0.999 * v_{n} + 0.001 * g_{n} * g_{n} AS v_{n}" for n in PARAMETERS]
    old = ", ".join([*PARAMETERS, *[f"{m}_{n}" for n in PARAMETERS for m in "mv"]])
    stepped = [
        f"{n} * (1 - {rate} * 0.01) - {rate} * (m_{n} / (1 - pow(0.9, {t}))) "
        f"/ (sqrt(v_{n} / (1 - pow(0.999, {t}))) + 1e-8) AS {n}"
        for n in PARAMETERS
    ]
    kept = [c for n in PARAMETERS for c in (f"m_{n}", f"v_{n}", f"g_{n}")]
    return [
        f"g{t} AS (SELECT {', '.join(sums)}{rest} FROM z{t})",
        f"s{t} AS (SELECT {', '.join([*PARAMETERS, *[f'g_{n}' for n in PARAMETERS], *first, *second])} "
        f"FROM (SELECT {old} FROM p{t - 1}) CROSS JOIN g{t})",
        f"p{t} AS (SELECT {', '.join([*stepped, *kept])} FROM s{t})",
    ]


def gradient_sql() -> str:
    """Two steps of softmax regression by hand; parameters are columns of one-row tables."""
    ctes = [LINE_ROWS.strip(), start_sql()]
    for t in (1, 2):
        ctes += [forward_sql(f"z{t}", "line_rows", f"p{t - 1}"), *step_sql(t, repr(RATE))]
    rows = []
    for i, n in enumerate(PARAMETERS):
        parameter, position = ("fc.weight", i) if i < 12 else ("fc.bias", i - 12)
        rows.append(
            f"SELECT '{parameter}' AS parameter, {position} AS position, "
            f"{r(f'g_{n}')} AS gradient, {r(n)} AS value FROM p2"
        )
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


def training_sql(rule: dict | None) -> str:
    """Epochs of one step on all training rows each, validation, best epochs and the plateau rule.

    The rule has no patience here: a loss that has not improved by one part in 10,000 lowers
    the rate at once, unless the change would be below 1e-8.
    """
    ctes = [LINE_ROWS.strip(), f"parts AS (SELECT *, {split_name('l_orderkey')} AS part FROM line_rows)"]
    ctes += [f"{s}_rows AS (SELECT * EXCLUDE (part) FROM parts WHERE part = '{s}')" for s in ("train", "val")]
    ctes.append(start_sql())
    ctes.append(f"h0 AS (SELECT CAST({TRAIN_RATE!r} AS DOUBLE) AS next_lr, CAST('inf' AS DOUBLE) AS least, 0.0 AS top)")
    for t in range(1, TRAIN_EPOCHS + 1):
        rate = f"(SELECT next_lr FROM h{t - 1})"
        ctes.append(forward_sql(f"z{t}", "train_rows", f"p{t - 1}"))
        more = ", sum(weight * ce) / count(*) AS train_loss, avg(CAST(hit AS INTEGER)) AS train_acc"
        ctes += step_sql(t, rate, more)
        ctes.append(forward_sql(f"c{t}", "val_rows", f"(SELECT {', '.join(PARAMETERS)} FROM p{t})"))
        ctes.append(f"v{t} AS (SELECT avg(ce) AS val_loss, avg(CAST(hit AS INTEGER)) AS val_acc FROM c{t})")
        better = "val_loss < least * (1.0 - 1e-4)"
        lower = f"greatest(next_lr * {(rule or {}).get('factor')!r}, {(rule or {}).get('min_lr')!r})"
        lowered = "next_lr" if rule is None else (
            f"CASE WHEN NOT ({better}) AND next_lr - {lower} > 1e-8 THEN {lower} ELSE next_lr END"
        )
        ctes.append(
            f"h{t} AS (SELECT next_lr AS lr, train_loss, train_acc, val_loss, val_acc, val_acc > top AS is_best, "
            f"greatest(top, val_acc) AS top, CASE WHEN {better} THEN val_loss ELSE least END AS least, "
            f"{lowered} AS next_lr FROM (SELECT next_lr, least, top FROM h{t - 1}) "
            f"CROSS JOIN g{t} CROSS JOIN v{t})"
        )
    numbers = ", ".join(f"{r(c)} AS {c}" for c in ("train_loss", "train_acc", "val_loss", "val_acc"))
    rows = [
        f"SELECT 'linear' AS run_id, CAST({t} AS INTEGER) AS epoch, round(lr, 9) AS lr, {numbers}, is_best FROM h{t}"
        for t in range(1, TRAIN_EPOCHS + 1)
    ]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(rows)}"


def lbfgs_sql() -> str:
    """Iterations with vectors as lists in one-row tables w (weights, loss), g (gradient), d (direction)."""
    net = NETWORKS["linear"]
    start = ", ".join(repr(float(v)) for v in fixed_weights(net))

    def dot(a: str, b: str) -> str:
        return f"list_dot_product({a}, {b})"

    def add(a: str, factor: str, b: str) -> str:
        return f"list_transform(list_zip({a}, {b}), lambda z: z[1] + ({factor}) * z[2])"

    def times(factor: str, a: str) -> str:
        return f"list_transform({a}, lambda v: ({factor}) * v)"

    z = ", ".join(f"w[{13 + k}] + " + " + ".join(f"w[{4 * k + j + 1}] * x{j}" for j in range(4)) for k in range(3))

    def rows(points: str) -> str:
        return (
            f"(SELECT *, weight * (ln(e[1] + e[2] + e[3]) - ln(e[label + 1])) AS part FROM (SELECT *, "
            f"list_transform([{z}], lambda v: exp(v)) AS e FROM line_rows CROSS JOIN {points}))"
        )

    slopes = [f"weight * (e[{k + 1}] / (e[1] + e[2] + e[3]) - CASE WHEN label = {k} THEN 1.0 ELSE 0.0 END)" for k in range(3)]
    sums = [f"avg({slopes[k]} * x{j})" for k in range(3) for j in range(4)] + [f"avg({slopes[k]})" for k in range(3)]
    gradient = f"[{', '.join(sums)}] AS g, avg(part) AS loss"
    ctes = [
        LINE_ROWS.strip(),
        f"w0 AS (SELECT [{start}]::DOUBLE[] AS w)",
        f"g0 AS (SELECT {gradient} FROM {rows('w0')})",
    ]
    lengths = ", ".join(repr(step) for step in STEPS)
    for t in range(1, LBFGS_ITERATIONS + 1):
        pairs = list(range(max(1, t - LBFGS_MEMORY), t))
        ctes.append(f"q{t}_{t} AS (SELECT g AS q FROM g{t - 1})")
        for i in reversed(pairs):
            share = f"{dot('s', 'q')} / {dot('y', 's')}"
            ctes.append(
                f"q{t}_{i} AS (SELECT k AS share, {add('q', '-k', 'y')} AS q "
                f"FROM (SELECT q, y, {share} AS k FROM q{t}_{i + 1} CROSS JOIN y{i}))"
            )
        last = f"q{t}_{pairs[0]}" if pairs else f"q{t}_{t}"
        size = f"(SELECT {dot('s', 'y')} / {dot('y', 'y')} FROM y{t - 1})" if pairs else "1.0"
        ctes.append(f"u{t}_0 AS (SELECT {times('k', 'q')} AS q FROM (SELECT q, {size} AS k FROM {last}))")
        for n, i in enumerate(pairs):
            more = f"(SELECT share FROM q{t}_{i}) - {dot('y', 'q')} / {dot('y', 's')}"
            ctes.append(
                f"u{t}_{n + 1} AS (SELECT {add('q', 'k', 's')} AS q "
                f"FROM (SELECT q, s, {more} AS k FROM u{t}_{n} CROSS JOIN y{i}))"
            )
        ctes.append(f"d{t} AS (SELECT {times('-1.0', 'q')} AS d FROM u{t}_{len(pairs)})")
        before = f"w{t - 1} CROSS JOIN d{t} CROSS JOIN g{t - 1}"
        ctes.append(f"c{t} AS (SELECT step, {add('w', 'step', 'd')} AS w FROM {before} CROSS JOIN (SELECT unnest([{lengths}]) AS step))")
        ctes.append(f"f{t} AS (SELECT step, avg(part) AS found FROM {rows(f'c{t}')} GROUP BY step)")
        ctes.append(
            f"t{t} AS (SELECT max(step) AS step FROM f{t} CROSS JOIN g{t - 1} CROSS JOIN d{t} "
            f"WHERE found <= loss + {GAIN!r} * step * {dot('g', 'd')})"
        )
        ctes.append(f"w{t} AS (SELECT w FROM c{t} WHERE step = (SELECT step FROM t{t}))")
        ctes.append(f"g{t} AS (SELECT {gradient} FROM {rows(f'w{t}')})")
        moved = add("b.w", "-1.0", "a.w")
        ctes.append(
            f"y{t} AS (SELECT {moved} AS s, {add('h.g', '-1.0', 'g.g')} AS y "
            f"FROM w{t - 1} a, w{t} b, g{t - 1} g, g{t} h)"
        )
    shown = [
        f"SELECT CAST({t} AS INTEGER) AS iteration, CAST(step AS DOUBLE) AS step, {r('loss')} AS loss, "
        f"CAST(i AS INTEGER) AS position, {r('w[i + 1]')} AS value "
        f"FROM t{t} CROSS JOIN w{t} CROSS JOIN g{t} CROSS JOIN range({net.size}) x(i)"
        for t in range(1, LBFGS_ITERATIONS + 1)
    ]
    return f"WITH {', '.join(ctes)} {' UNION ALL '.join(shown)}"


def stream_evaluation_sql() -> str:
    ctes, _, last = network_sql("rnn", ["label"])
    loss = "ln(exp(z0) + exp(z1) + exp(z2)) - list_extract([z0, z1, z2], label + 1)"
    return (
        f"WITH {ctes} SELECT label, CAST({PREDICTED} AS BIGINT) AS prediction, count(*) AS n, "
        f"{r(f'avg({loss})')} AS mean_loss FROM {last} GROUP BY ALL"
    )


def scaled(columns: list[str]) -> str:
    return ", ".join(
        f"{r(f'{c} / (SELECT stddev_samp({c}) FROM base)')} AS f{i}" for i, c in enumerate(columns)
    )


def category_chain(source: str, columns: list[str]) -> str:
    """Index tables fitted one after the other, each on the rows the earlier ones leave."""
    parts = []
    for i, c in enumerate(columns):
        earlier = " AND ".join(f"{e} IS NOT NULL" for e in columns[:i]) or "true"
        parts.append(f"idx_{c} AS ({index_table(source, c, earlier)})")
    return ", ".join(parts)


def sql() -> dict[str, str]:
    lines = ", ".join(LINE_FEATURES)
    start, factor = PLATEAU["start"], PLATEAU["factor"]
    names = {i: n for i, n in REPORT_CLASSES}
    report_classes = " UNION ALL ".join(
        f"SELECT {i} AS idx, '{n}' AS name" for i, n in names.items()
    )
    event_shards = (
        f"CAST(ceil((SELECT count(*) FROM events) / {EVENT_SHARD_ROWS}.0) AS BIGINT)"
    )
    fifth = "count(*) >= ceil((SELECT count(*) FROM events) / 5.0)"
    evaluated, _, last = network_sql("gru", ["label"])
    train_split = split_name("o_orderkey")
    prepared = f"""
        WITH kept AS (SELECT CAST(l_suppkey AS VARCHAR) AS supp, {lines}, l_linestatus, l_returnflag,
            NOT (l_linenumber = 7 AND l_quantity IN ({', '.join(str(q) for _, q, _ in BAD_TEXT)})) AS good
          FROM lineitem WHERE l_returnflag IN
            (SELECT l_returnflag FROM lineitem GROUP BY l_returnflag
             HAVING count(*) >= ceil((SELECT count(*) FROM lineitem) / 3.0))),
        {category_chain('kept', ['supp', 'l_linestatus'])},
        labels AS ({index_table('kept', 'l_returnflag', 'good')}),
        base AS (SELECT {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in LINE_FEATURES)},
                        CAST(a.idx AS DOUBLE) AS s, CAST(b.idx AS DOUBLE) AS t,
                        CAST(labels.idx AS DOUBLE) AS label, labels.weight AS weight
                 FROM kept JOIN idx_supp a ON supp = a.value
                 JOIN idx_l_linestatus b ON l_linestatus = b.value
                 JOIN labels ON l_returnflag = labels.value WHERE good)
        SELECT {scaled([*LINE_FEATURES, 's', 't'])}, label, {r('weight')} AS weight FROM base"""
    return {
        "scan_csv": """
            SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
                   event_type, CAST(value AS VARCHAR) AS value, props FROM events""",
        "scan_parquet": "SELECT l_orderkey, l_extendedprice, l_returnflag FROM lineitem",
        "sink_parquet": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders",
        "mini_sample": """
            SELECT event_id, user_id, event_type, value FROM events ORDER BY event_id LIMIT 1000""",
        "stage_shards": f"""
            WITH {EVENT_ROWS},
            sums AS (
              SELECT count(*) AS rows, CAST(sum(label) AS DOUBLE) AS label_sum,
                     round(sum(weight), 3) AS weight_sum, round(sum(x0), 3) AS x0,
                     round(sum(x1), 3) AS x1, round(sum(x2), 3) AS x2 FROM event_rows),
            dealt AS (SELECT CAST(s AS INTEGER) AS shard, (rows - s + 3) // 4 AS n, sums.* FROM range(4) t(s), sums)
            SELECT shard, n, n AS positions, n - 1 AS last, label_sum, weight_sum, x0, x1, x2
            FROM dealt""",
        "shard_plan": f"""
            SELECT w AS worker, ({PLAN_FILES} - w + {PLAN_WORKERS - 1}) // {PLAN_WORKERS} AS n_files,
                   n // {PLAN_WORKERS} AS samples,
                   n // {PLAN_WORKERS * PLAN_BATCH} AS steps_per_epoch
            FROM range({PLAN_WORKERS}) t(w), (SELECT count(*) AS n FROM events)""",
        "batch_scan": f"""
            WITH {EVENT_ROWS}
            SELECT CAST({bucket('event_id', event_shards)} AS INTEGER) AS shard,
                   CAST(ceil(count(*) / {EVENT_BATCH}.0) AS BIGINT) AS batches, count(*) AS n,
                   CAST(sum(label) AS BIGINT) AS label_sum,
                   round(sum(CAST(CAST(weight AS FLOAT) AS DOUBLE)), 3) AS weight_sum,
                   round(sum(CAST(CAST(x0 AS FLOAT) AS DOUBLE) + CAST(CAST(x1 AS FLOAT) AS DOUBLE)
                             + CAST(CAST(x2 AS FLOAT) AS DOUBLE)), 3) AS feature_sum
            FROM event_rows GROUP BY 1""",
        "endless_batches": f"""
            WITH {EVENT_ROWS},
            sizes AS (SELECT CAST((n + {PLAN_FILES - 1} - s) // {PLAN_FILES} AS BIGINT) AS size
                      FROM range({PLAN_FILES}) t(s), (SELECT count(*) AS n FROM event_rows)),
            batches AS (SELECT CAST(max(ceil(size / {EVENT_BATCH}.0)) AS BIGINT) AS steps,
                               CAST(sum(ceil(size / {EVENT_BATCH}.0)) AS BIGINT) AS batches,
                               least(max(size), {EVENT_BATCH}) AS largest FROM sizes),
            sums AS (SELECT count(*) AS n, CAST(sum(label) AS BIGINT) AS label_sum,
                            round(sum(x0 + x1 + x2), 3) AS feature_sum FROM event_rows)
            SELECT CAST(turn AS BIGINT) AS pass, steps, batches, largest, n, label_sum, feature_sum
            FROM range(2) t(turn), batches, sums""",
        "stream_score": score_sql("rnn"),
        "sink_report_json": report_sql(LINE_PAIRS, report_classes),
        "transform_roundtrip": f"""
            WITH labels AS ({index_table('lineitem', 'l_returnflag')}),
            status AS ({index_table('lineitem', 'l_linestatus')}),
            base AS (SELECT l_orderkey, l_quantity, l_extendedprice, l_discount,
                            CAST(status.idx AS DOUBLE) AS s, CAST(labels.idx AS DOUBLE) AS label
                     FROM lineitem JOIN labels ON l_returnflag = labels.value
                     JOIN status ON l_linestatus = status.value)
            SELECT l_orderkey, {scaled(['l_quantity', 'l_extendedprice', 'l_discount', 's'])}, label
            FROM base""",
        "drop_if_present": "SELECT event_id, user_id, event_type, value FROM events",
        "cast_numeric": """
            SELECT event_id, value, event_type, TRY_CAST(props AS DOUBLE) AS props FROM events""",
        "select_strings": "SELECT p_name, p_type FROM part",
        "select_features": """
            SELECT l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem""",
        "vector_to_array": f"""
            WITH v AS (SELECT vec_id, CASE WHEN label = 3 THEN CAST([] AS DOUBLE[])
                              ELSE CAST(embedding AS DOUBLE[]) END AS v FROM embeddings)
            SELECT vec_id, CAST(len(v) AS INTEGER) AS width, {r('v[1]')} AS first,
                   {r('coalesce(list_sum(v), 0.0)')} AS total FROM v""",
        "filter_isin": """
            SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'error')""",
        "sample_fraction": f"""
            SELECT event_id, value FROM events
            WHERE {bucket('event_id', 2**32)} < 0.25 * 4294967296""",
        "filter_rare_classes": f"""
            SELECT event_id, event_type FROM events WHERE event_type IN
              (SELECT event_type FROM events GROUP BY event_type HAVING {fifth})""",
        "attach_class_weight": f"""
            WITH kept AS (SELECT event_type, count(*) AS n FROM events GROUP BY ALL HAVING {fifth}),
            weights AS (SELECT event_type,
                               (SELECT sum(n) FROM kept) / ((SELECT count(*) FROM kept) * CAST(n AS DOUBLE)) AS w
                        FROM kept)
            SELECT event_id, events.event_type, {r('coalesce(w, 1.0)')} AS weight
            FROM events LEFT JOIN weights ON events.event_type = weights.event_type""",
        "decode_labels": f"""
            WITH labels AS ({index_table('orders', 'o_orderpriority')})
            SELECT o_orderkey, CAST(mine.idx + 1 AS DOUBLE) AS label, other.value AS name
            FROM orders JOIN labels mine ON o_orderpriority = mine.value
            LEFT JOIN labels other ON other.idx = mine.idx + 1""",
        "split_counts": f"""
            SELECT {split_name('event_id')} AS split, count(*) AS n FROM events GROUP BY 1""",
        "class_counts": "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
        "class_weights": f"""
            WITH labels AS ({index_table('orders', 'o_orderpriority')})
            SELECT value AS o_orderpriority, n, {r('weight')} AS weight FROM labels""",
        "label_index": f"""
            WITH labels AS ({index_table('orders', 'o_orderpriority')})
            SELECT value AS o_orderpriority, n, idx AS index FROM labels""",
        "hash_split": f"SELECT o_orderkey, {train_split} AS split FROM orders",
        "scaler_stats": " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS feature, round(avg({c}), 5) AS mean, "
            f"round(stddev_samp({c}), 5) AS std FROM lineitem"
            for i, c in enumerate(LINE_FEATURES)
        ),
        "index_categories": f"""
            WITH base AS (SELECT p_partkey, nullif(p_name, 'red widget') AS p_name, p_brand, p_type
                          FROM part),
            {category_chain('base', ['p_name', 'p_brand', 'p_type'])}
            SELECT p_partkey, CAST(a.idx AS DOUBLE) AS p_name_index,
                   CAST(b.idx AS DOUBLE) AS p_brand_index, CAST(c.idx AS DOUBLE) AS p_type_index
            FROM base JOIN idx_p_name a ON p_name = a.value JOIN idx_p_brand b ON p_brand = b.value
            JOIN idx_p_type c ON p_type = c.value""",
        "assemble_features": f"""
            SELECT l_orderkey, {', '.join(f'{r(c)} AS f{i}' for i, c in enumerate(LINE_FEATURES))}
            FROM lineitem WHERE l_tax <> 0.0""",
        "standard_scale": f"""
            WITH base AS (SELECT l_orderkey, {lines} FROM lineitem)
            SELECT l_orderkey, {scaled(LINE_FEATURES)} FROM base""",
        "preprocess": prepared,
        "preprocess_merged": prepared,
        "preprocess_fit_on_train": f"""
            WITH train AS (SELECT * FROM orders WHERE {train_split} = 'train'),
            labels AS ({index_table('train', 'o_orderstatus')}),
            priority AS ({index_table('train', 'o_orderpriority')}),
            stds AS (SELECT stddev_samp(o_totalprice) AS a, stddev_samp(priority.idx) AS b
                     FROM train JOIN priority ON o_orderpriority = priority.value)
            SELECT o_orderkey, {r('o_totalprice / (SELECT a FROM stds)')} AS f0,
                   {r('priority.idx / (SELECT b FROM stds)')} AS f1,
                   CAST(labels.idx AS DOUBLE) AS label, {r('labels.weight')} AS weight,
                   {train_split} AS split
            FROM orders JOIN priority ON o_orderpriority = priority.value
            JOIN labels ON o_orderstatus = labels.value""",
        "dataset_metadata": """
            SELECT count(*) AS num_rows, count(DISTINCT label) AS num_classes,
                   CAST(max(len(embedding)) AS INTEGER) AS num_features FROM embeddings""",
        "confusion_matrix": f"WITH {LINE_PAIRS}, {MATRIX} SELECT label, prediction, n FROM matrix",
        "confusion_pct": f"""
            WITH {LINE_PAIRS}, {MATRIX},
            shares AS (SELECT *, CAST(n AS DOUBLE) / nullif(sum(n) OVER (PARTITION BY label), 0) * 100 AS s
                       FROM matrix)
            SELECT label, prediction, n, {r('s')} AS pct FROM shares""",
        "classification_report": report_sql(LINE_PAIRS, report_classes),
        "cross_entropy": f"WITH {EMBEDDING} SELECT vec_id, {r('ce')} AS loss FROM losses",
        "argmax_predict": f"""
            WITH {EMBEDDING} SELECT vec_id, CAST(prediction AS BIGINT) AS prediction FROM losses""",
        "accuracy_loss": f"""
            WITH {EMBEDDING}, means AS (
              SELECT count(*) AS n, avg(ce) AS l,
                     avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END) AS a FROM losses)
            SELECT n AS rows, {r('l')} AS loss, {r('a')} AS accuracy FROM means""",
        "weighted_loss": f"""
            WITH {EMBEDDING}, sums AS (SELECT count(*) AS n, sum(ce * weight) AS s FROM losses)
            SELECT n AS rows, round(s, 4) AS loss_sum, {r('s / n')} AS loss FROM sums""",
        "best_epochs": f"""
            WITH {HISTORY}
            SELECT *, val_acc > coalesce(max(val_acc) OVER (PARTITION BY run_id ORDER BY epoch
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS is_best
            FROM history""",
        "plateau_lr": f"""
            WITH RECURSIVE {HISTORY},
            steps AS (SELECT run_id, epoch, val_loss,
                             row_number() OVER (PARTITION BY run_id ORDER BY epoch) AS i FROM history),
            fold AS (
              SELECT run_id, epoch, val_loss, i, val_loss AS best, 0 AS bad,
                     CAST({start} AS DOUBLE) AS lr FROM steps WHERE i = 1
              UNION ALL
              SELECT run_id, epoch, val_loss, i,
                     CASE WHEN better THEN val_loss ELSE best END,
                     CASE WHEN better OR bad + 1 > {PLATEAU['patience']} THEN 0 ELSE bad + 1 END,
                     CASE WHEN NOT better AND bad + 1 > {PLATEAU['patience']} AND lr - lower > 1e-8
                          THEN lower ELSE lr END
              FROM (SELECT s.*, f.best, f.bad, f.lr,
                           s.val_loss < f.best * (1.0 - CAST(0.0001 AS DOUBLE)) AS better,
                           greatest(f.lr * {factor}, CAST({PLATEAU['min_lr']!r} AS DOUBLE)) AS lower
                    FROM fold f JOIN steps s ON s.run_id = f.run_id AND s.i = f.i + 1))
            SELECT run_id, epoch, val_loss AS loss, round(lr, 9) AS lr FROM fold""",
        **{f"score_{kind}": score_sql(kind) for kind in ("rnn", "lstm", "gru", "transformer")},
        "train_gradient_step": gradient_sql(),
        "train_network": training_sql(None),
        "train_resumed": training_sql(TRAIN_RULE),
        "train_lbfgs": lbfgs_sql(),
        "stream_evaluate": stream_evaluation_sql(),
        "training_history": training_sql(TRAIN_RULE),
        "evaluate_test_set": report_sql(
            f"{evaluated}, counts AS (SELECT label, {PREDICTED} AS prediction, count(*) AS n "
            f"FROM {last} GROUP BY ALL)",
            "SELECT idx, value AS name FROM labels",
        ),
    }
