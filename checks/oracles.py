"""The same relations and queries as DuckDB SQL over the test tables."""

from checks.relations import END_YEAR, INSTRUCTION, START_YEAR

INSTRUCTION_SQL = "'" + INSTRUCTION.strip().replace("'", "''") + "'"

EXPIRY_SQL = """CAST(CASE {market}
    WHEN 'africa' THEN last_day(f) - CAST(greatest(isodow(last_day(f)) - 5, 0) AS INTEGER)
    WHEN 'america' THEN f + 14
    WHEN 'asia' THEN (last_day(f) + 1) + CASE isodow(last_day(f) + 1)
                       WHEN 1 THEN 4 WHEN 6 THEN 5 WHEN 7 THEN 4 ELSE 6 END
    ELSE last_day(f) END AS DATE)"""

# name -> (names it builds on, body)
VIEWS = {
    "instrument": (
        [],
        """SELECT CAST(n_nationkey AS INTEGER) AS ord, lower(r_name) AS market, n_name AS name,
         CASE n_nationkey % 3 WHEN 0 THEN 'cme' WHEN 1 THEN 'yahoo' ELSE 'index' END AS data_source,
         CASE WHEN n_nationkey % 3 = 2 THEN NULL
              ELSE 'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS symbol
  FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "listing": (
        [],
        """SELECT CAST(s_suppkey AS INTEGER) AS ord, lower(r_name) AS market, s_name AS name,
         'cme' AS data_source, 'S' || CAST(s_suppkey AS VARCHAR) AS symbol
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
    "trade": (
        [],
        """SELECT CAST(l_shipdate AS DATE) AS trade_date, n_nationkey AS k, n_name AS product, l_quantity AS q,
         round_even(l_extendedprice / l_quantity, 4) AS px,
         year(l_shipdate) * 12 + month(l_shipdate) - 1 + 1 + l_linenumber % 3 AS mi,
         l_orderkey AS a, l_linenumber AS b, l_partkey AS c, l_suppkey AS d, l_extendedprice AS e
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    ),
    "trade_sym": (
        ["trade"],
        """SELECT *, CASE WHEN k % 3 = 2 THEN NULL
                 WHEN k % 3 = 1 THEN 'N' || lpad(CAST(k AS VARCHAR), 2, '0')
                 ELSE 'N' || lpad(CAST(k AS VARCHAR), 2, '0')
                      || substr('FGHJKMNQUVXZ', CAST(mi % 12 + 1 AS INTEGER), 1)
                      || CAST((mi // 12) % 10 AS VARCHAR) END AS symbol
  FROM trade""",
    ),
    "trade_rn": (
        ["trade_sym"],
        """SELECT *, row_number() OVER (PARTITION BY trade_date, product, symbol ORDER BY a, b, c, d, e) AS up,
            row_number() OVER (PARTITION BY trade_date, product, symbol
                               ORDER BY a DESC, b DESC, c DESC, d DESC, e DESC) AS down
  FROM trade_sym""",
    ),
    "bar": (
        ["trade_rn"],
        """SELECT trade_date, product, symbol, max(CASE WHEN up = 1 THEN px END) AS open, max(px) AS high,
         min(px) AS low, max(CASE WHEN down = 1 THEN px END) AS close, sum(q) AS volume,
         CAST(max(k) AS INTEGER) AS seq
  FROM trade_rn GROUP BY trade_date, product, symbol""",
    ),
    "bar_dup": (
        ["bar"],
        """SELECT * REPLACE (CAST(1 AS INTEGER) AS seq) FROM bar
  UNION ALL SELECT * REPLACE (CAST(2 AS INTEGER) AS seq, round_even(close, 2) AS close) FROM bar""",
    ),
    "contract": (
        ["instrument"],
        f"""SELECT ord, market, name, symbol AS base_symbol,
         symbol || substr('FGHJKMNQUVXZ', CAST(m AS INTEGER), 1) || CAST(y % 10 AS VARCHAR) AS symbol,
         CAST(y AS INTEGER) AS contract_year, CAST(m AS INTEGER) AS contract_month,
         {EXPIRY_SQL.format(market='market')} AS expiration_date
  FROM (SELECT i.*, y, m, make_date(y, m, 1) AS f
        FROM instrument i, range({START_YEAR}, {END_YEAR + 1}) t(y), range(1, 13) u(m)
        WHERE i.data_source = 'cme' AND i.symbol IS NOT NULL)""",
    ),
    "report": (
        [],
        """SELECT o_orderkey AS report_id, substr(o_orderpriority, 3) AS source, lower(r_name) AS market,
         strftime(o_orderdate, '%m/%d/%Y') AS date, CAST(o_orderdate AS DATE) AS report_date, text AS passage
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey
       JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)""",
    ),
    "split_ref": (
        ["report"],
        """SELECT DISTINCT source, market, report_date,
         CASE WHEN year(report_date) <= 1998 THEN 'train'
              WHEN year(report_date) = 1999 THEN 'validate' ELSE 'test' END AS split
  FROM report""",
    ),
    "example": (["report"], "SELECT * RENAME (report_id AS example_id) FROM report"),
    # A table depends on market and date only.
    "day": (["report"], "SELECT DISTINCT market, report_date FROM report"),
    "active": (
        ["day", "contract"],
        """SELECT * FROM (
    SELECT r.market, r.report_date, c.ord, c.name, c.symbol, c.expiration_date,
           row_number() OVER (PARTITION BY r.market, r.report_date, c.ord
                              ORDER BY c.expiration_date, c.symbol) AS rk
    FROM day r JOIN contract c ON r.market = c.market AND c.expiration_date > r.report_date)
  WHERE rk <= 3""",
    ),
    "labelled": (
        ["active"],
        """SELECT *, name || ' (' || CASE rk WHEN 1 THEN 'front month' WHEN 2 THEN 'second month'
           ELSE 'third month' END || ') (' || strftime(expiration_date, '%B') || ')' AS label
  FROM active""",
    ),
}


def found_views(history, suffix="", spans=None):
    """Table rows of every market day under one history span, or under several."""
    if spans:
        values = ", ".join(f"('{k}', {v})" for k, v in spans.items())
        days = f"SELECT day.*, span, report_date - d AS first_day FROM day, (VALUES {values}) s(span, d)"
        key = "market, report_date, span"
    else:
        days = f"SELECT *, report_date - {history} AS first_day FROM day"
        key = "market, report_date"
    own = key.replace("market", "w.market").replace(", report_date", ", w.report_date")
    own = own.replace(", span", ", w.span")
    found = f"""SELECT {own}, 'symbol' AS route, a.ord, b.seq, b.trade_date, a.label, a.label AS product,
         b.symbol, b.open, b.high, b.low, b.close, b.volume
  FROM win{suffix} w JOIN labelled a ON a.market = w.market AND a.report_date = w.report_date
       JOIN bar b ON b.symbol = a.symbol AND b.trade_date BETWEEN w.first_day AND w.report_date
  UNION ALL
  SELECT {own}, 'symbol', i.ord, b.seq, b.trade_date, NULL, b.product, b.symbol, b.open, b.high, b.low, b.close, b.volume
  FROM win{suffix} w JOIN instrument i ON w.market = i.market AND i.data_source <> 'cme'
       JOIN bar b ON b.symbol = i.symbol AND b.trade_date BETWEEN w.first_day AND w.report_date
  UNION ALL
  SELECT {own}, 'product', i.ord, b.seq, b.trade_date, NULL, b.product, b.symbol, b.open, b.high, b.low, b.close, b.volume
  FROM win{suffix} w JOIN instrument i ON w.market = i.market AND i.symbol IS NULL
       JOIN bar b ON b.product = i.name AND b.trade_date BETWEEN w.first_day AND w.report_date"""
    table = f"""SELECT {key}, CAST(row_number() OVER (PARTITION BY {key}
           ORDER BY ord, label NULLS FIRST, CASE WHEN label IS NULL THEN seq END, trade_date, product,
                    symbol NULLS LAST) AS INTEGER) AS row_no,
         trade_date, product, symbol, open, high, low, close, volume
  FROM (SELECT *, row_number() OVER (PARTITION BY {key}, trade_date, product, symbol
                                     ORDER BY ord, seq) AS dup FROM found{suffix})
  WHERE dup = 1"""
    return {
        f"win{suffix}": (["day"], days),
        f"found{suffix}": ([f"win{suffix}", "labelled", "instrument", "bar"], found),
        f"tab{suffix}": ([f"found{suffix}"], table),
    }


def rendered_view():
    """Text table of every market day, by the layout rules of ``tapeloom.operators.render``."""
    numbers = ["open", "high", "low", "close", "volume"]
    titles = {"trade_date": "Date", "product": "Product Name", "symbol": "Symbol"}
    titles |= {c: c.capitalize() for c in numbers}
    text, stats, cells, heads = [], [], [], []
    for c in numbers:
        fixed = f"CAST(CAST({c} AS DECIMAL(38,6)) AS VARCHAR)"
        text.append(f"{fixed} AS {c}_t, length({fixed}) - 7 AS {c}_w, length(rtrim({fixed}, '0')) AS {c}_r")
        stats.append(
            f"max({c}_w) OVER g AS {c}_mw, greatest(max({c}_r - {c}_w - 1) OVER g, 1) AS {c}_p, "
            f"coalesce(max(abs({c})) OVER g, 0) > 1e6 AS {c}_big, "
            f"count(*) OVER g > count({c}) OVER g AS {c}_nul, "
            f"CASE WHEN min({c}) OVER g < 0 THEN 1 ELSE 0 END AS {c}_neg"
        )
        sci = f"({c}_big AND {c}_mw + 1 + {c}_p > 12)"
        width = (
            f"greatest({len(titles[c]) + 1}, CASE WHEN {sci} THEN 12 + {c}_neg ELSE {c}_mw + 1 + {c}_p END, "
            f"CASE WHEN {c}_nul THEN 3 ELSE 0 END)"
        )
        cell = (
            f"CASE WHEN {c} IS NULL THEN 'NaN' WHEN {sci} THEN format('{{:.6e}}', {c}) "
            f"ELSE substr({c}_t, 1, CAST({c}_w + 1 + {c}_p AS INTEGER)) END"
        )
        cells.append(f"lpad({cell}, CAST({width} AS INTEGER), ' ')")
        heads.append(f"lpad('{titles[c]}', CAST({width} AS INTEGER), ' ')")
    words = ["trade_date", "product", "symbol"]
    for c in words:
        text.append(f"coalesce(CAST({c} AS VARCHAR), 'NaN') AS {c}_t")
        none = f"CASE WHEN count({c}) OVER g = 0 THEN 1 ELSE 0 END"
        stats.append(f"greatest({len(titles[c])} + {none}, max(length({c}_t)) OVER g) AS {c}_width")
    word_cells = [f"lpad({c}_t, CAST({c}_width AS INTEGER), ' ')" for c in words]
    word_heads = [f"lpad('{titles[c]}', CAST({c}_width AS INTEGER), ' ')" for c in words]
    return f"""SELECT market, report_date,
         any_value(head) || chr(10) || string_agg(line, chr(10) ORDER BY row_no) AS table_data
  FROM (SELECT market, report_date, row_no, concat_ws(' ', {', '.join(word_heads + heads)}) AS head,
               concat_ws(' ', {', '.join(word_cells + cells)}) AS line
        FROM (SELECT *, {', '.join(stats)}
              FROM (SELECT *, {', '.join(text)} FROM tab)
              WINDOW g AS (PARTITION BY market, report_date)))
  GROUP BY market, report_date"""


VIEWS |= found_views(7)
VIEWS["rendered"] = (["tab"], rendered_view())
VIEWS["keyed"] = (
    ["split_ref", "rendered"],
    """SELECT s.split, s.source, s.market, s.report_date, r.table_data
  FROM split_ref s JOIN rendered r ON s.market = r.market AND s.report_date = r.report_date""",
)


def sample_view(source, keys, n, date_out=None):
    """Seeded sample: rows ``n`` per group with their place in the list."""
    return f"""SELECT * EXCLUDE (draw, big),
         row_number() OVER (PARTITION BY {keys} ORDER BY CASE WHEN big THEN draw END, example_id) AS place
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
                    ORDER BY md5('7|' || CAST(example_id AS VARCHAR)), example_id) AS draw,
               count(*) OVER (PARTITION BY {keys}) > {n} AS big FROM {source})
  WHERE draw <= {n}"""


def report_block(alias="x", place="place"):
    return (
        f"'Report Example ' || CAST({place} AS VARCHAR) || ':' || chr(10) || 'Market: ' || {alias}.market || chr(10) || "
        f"'Date: ' || {alias}.date || chr(10) || 'Report:' || chr(10) || {alias}.passage || chr(10) || '---'"
    )


def data_block(alias="x", place="place"):
    return (
        f"'Data Example ' || CAST({place} AS VARCHAR) || ':' || chr(10) || 'Market: ' || {alias}.market || chr(10) || "
        f"'Date: ' || {alias}.date || chr(10) || 'Table Data:' || chr(10) || {alias}.table_data || chr(10) || chr(10) || "
        f"'Report:' || chr(10) || {alias}.passage || chr(10) || '---'"
    )


VIEWS["report_sample"] = (["example"], sample_view("example", "market, source", 2))
VIEWS["report_blocks"] = (
    ["report_sample"],
    f"""SELECT market, source, count(*) AS n_examples,
         string_agg({report_block()}, chr(10) ORDER BY place) AS blocks
  FROM report_sample x GROUP BY market, source""",
)
VIEWS["data_example"] = (
    ["example", "keyed"],
    "SELECT e.*, k.split, k.table_data FROM example e JOIN keyed k USING (source, market, report_date)",
)
VIEWS["data_sample"] = (["data_example"], sample_view("data_example", "split, market, source", 1))
VIEWS["data_blocks"] = (
    ["data_sample"],
    f"""SELECT split, market, source, string_agg({data_block()}, chr(10) ORDER BY place) AS blocks
  FROM data_sample x GROUP BY split, market, source""",
)

INPUT_SQL = (
    "chr(10) || 'Input:' || chr(10) || 'Market: ' || r.market || chr(10) || 'Date: ' || r.date || chr(10) || "
    "'Table Data:' || chr(10) || k.table_data || chr(10) || chr(10) || "
    "'Generate a report based on the table data above.'"
)


def prompt_sql(data, report):
    """Prompt text from the optional block columns."""
    return f"""concat_ws(chr(10), {INSTRUCTION_SQL},
      CASE WHEN {data} IS NOT NULL THEN chr(10) || 'Data Examples:' || chr(10) || {data} END,
      CASE WHEN {report} IS NOT NULL THEN chr(10) || 'Report Style Examples:' || chr(10) || {report} END,
      {INPUT_SQL})"""


VIEWS["prompted"] = (
    ["report", "keyed", "report_blocks"],
    f"""SELECT k.split, r.report_id, r.source, r.market, r.date, r.report_date, k.table_data, r.passage,
         b.n_examples, {prompt_sql("NULL", "b.blocks")} AS formatted_prompt
  FROM report r JOIN keyed k USING (source, market, report_date)
       LEFT JOIN report_blocks b ON b.market = r.market AND b.source = r.source""",
)
VIEWS["pairs"] = (
    ["prompted"],
    f"""SELECT split, report_id, report_date, passage AS target,
         'Instruction: ' || {INSTRUCTION_SQL} || chr(10) || 'Generate report for date ' || date || chr(10)
         || 'Table:' || chr(10) || table_data || chr(10) || 'Report:' AS context
  FROM prompted""",
)


def ids_sql(text):
    return (
        "list_transform(list_filter(string_split_regex(" + text + r", '[ \t\n\r\f\x0B]+'), lambda w: w <> ''), "
        "lambda w: CAST(concat('0x', substr(md5(w), 1, 8)) AS BIGINT))"
    )


VIEWS["encoded"] = (
    ["pairs"],
    f"""SELECT split, report_id, report_date, {ids_sql('context')} AS input_ids, {ids_sql('target')} AS labels
  FROM pairs""",
)


def with_views(names, body, extra=None):
    """``body`` under the WITH clause of the views it needs, in dependency order."""
    known = VIEWS | (extra or {})
    done = {}

    def add(name):
        if name not in done:
            needs, text = known[name]
            for need in needs:
                add(need)
            done[name] = text

    for name in names:
        add(name)
    clauses = ",\n".join(f"{name} AS (\n  {text})" for name, text in done.items())
    return f"WITH {clauses}\n{body}" if clauses else body
