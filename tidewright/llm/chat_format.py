"""Chat formatting: hashes of nested field paths select the mapping that turns a record into canonical turns.

Records of several layouts live in one DataFrame (as JSON or schema-merged Parquet gives them): a field that a record
lacks is null. A record's fingerprint is the hash of the sorted paths of those fields that hold something, of the paths
that any layout requires; other columns don't count, whatever their names. Each layout is declared by its required and
optional paths and by where its turns come from, and stands for the fingerprints with its required paths and without
those of a layout before it. Known paths that a record fills and its layout has no place for are listed in
``unmapped``. Records without a layout keep a row, with a null layout and no turns; ``conversations`` counts them for
each id, and ``rejects`` gives them whole.

A formatted text marks turns by ``### role: text</turn>\\n``. Inside roles and texts a backslash becomes ``\\b``, ``###``
becomes ``\\h``, ``</turn>`` becomes ``\\t`` and, in roles, ``:`` becomes ``\\c``; a null role is ``\\0``. An escaped text
thus holds neither mark, so splitting at the marks and undoing the escapes gives the turns back. The loss mask is a list
of (turn, start, length) spans: the turn's number in the formatted text, and where the assistant's escaped text begins
and how long it is, in characters of that turn. Writing and reading take time in proportion to the text.

Null texts are empty texts. Repeated and tied turns all stay, ordered by (turn, role, text), null turns last. In a table
of turns alone a record of nulls is an empty turn. An empty table gives no
conversation. Everything is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURNS = "array<struct<role:string,text:string>>"
END, HEAD = "</turn>\n", "### "


@dataclass(frozen=True)
class Layout:
    """``turns``: (role, path) pairs of single fields in order; or ``each``: (array path, role field, text field), with
    ``roles`` to rename roles; or ``row``: (order path, role path, text path) of a record that is one turn."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    row: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        return {*self.required, *self.optional}


#: The field names of common public data sets.
SHAREGPT_ROLES = (("human", "user"), ("gpt", "assistant"), ("system", "system"))
TURN_ROW = ("turn", "role", "text")
#: The first layout whose required paths a record fills is its own. One that requires nothing counts only where the table
#: has all its paths and none of a layout of another name.
LAYOUTS = (
    Layout("turn_row", ("turn",), ("role", "text"), row=TURN_ROW),
    Layout("turn_row", ("role", "text"), ("turn",), row=TURN_ROW),
    Layout("messages", ("messages[].role",), ("messages[].content",), each=("messages", "role", "content")),
    Layout("sharegpt", ("conversations[].from",), ("conversations[].value",), each=("conversations", "from", "value"), roles=SHAREGPT_ROLES),
    Layout("instruction", ("instruction",), ("input", "output"), turns=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("prompt_completion", ("prompt",), ("completion", "system"), turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Layout("question_answer", ("question",), ("answer", "context"), turns=(("user", "context"), ("user", "question"), ("assistant", "answer"))),
    Layout("turn_row", ("role",), ("turn", "text"), row=TURN_ROW),
    Layout("turn_row", ("text",), ("turn", "role"), row=TURN_ROW),
    Layout("turn_row", (), ("turn", "role", "text"), row=TURN_ROW),
)


def _schema_paths(df: DataFrame) -> set[str]:
    """Nested field paths of the DataFrame; ``a[].b`` for a field of the structs in array ``a``."""
    from pyspark.sql.types import ArrayType, StructType

    found: set[str] = set()

    def walk(kind, at: str) -> None:
        if isinstance(kind, ArrayType):
            walk(kind.elementType, f"{at}[]")
        elif isinstance(kind, StructType):
            for f in kind.fields:
                walk(f.dataType, f"{at}.{f.name}" if at else f.name)
        else:
            found.add(at)

    walk(df.schema, "")
    return found


def _present(path: str) -> Column:
    if "[]." in path:
        array, field = path.split("[].", 1)
        return F.coalesce(F.exists(F.col(array), lambda x: x.getField(field).isNotNull()), F.lit(False))
    return F.col(path).isNotNull()


def _hash_paths(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _usable(layouts: tuple[Layout, ...], have: set[str]) -> list[Layout]:
    alone = lambda x: x.paths() <= have and not any(y.paths() & have for y in layouts if y.name != x.name)
    return [x for x in layouts if (set(x.required) <= have if x.required else alone(x))]


def _telling(usable: list[Layout]) -> list[str]:
    return sorted(set().union(*(x.required for x in usable)))


def fingerprints(usable: list[Layout]) -> list[list[tuple[str, ...]]]:
    """For each layout the sets of telling paths that stand for it."""
    told = _telling(usable)
    found: list[list[tuple[str, ...]]] = [[] for _ in usable]
    for n in range(len(told) + 1):
        for some in combinations(told, n):
            first = next((i for i, x in enumerate(usable) if set(x.required) <= set(some)), None)
            if first is not None:
                found[first].append(some)
    return found


def _filled(paths: list[str]) -> Column:
    return F.array_compact(F.array(*[F.when(_present(p), F.lit(p)) for p in paths]) if paths else F.array(F.lit(None).cast("string")))


def fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """The hash of the sorted telling paths that a record fills."""
    return _hash_paths(_filled(_telling(_usable(layouts, _schema_paths(df)))))


def _turn(role: Column, text: Column) -> Column:
    return F.struct(role.cast("string").alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


def _mapped(layout: Layout, have: set[str]) -> Column:
    field = lambda p: F.col(p) if p in have else F.lit(None).cast("string")
    if layout.row:
        return F.array(_turn(field(layout.row[1]), field(layout.row[2])))
    if layout.each:
        array, role, text = layout.each
        names = F.create_map(*[F.lit(x) for pair in layout.roles for x in pair]) if layout.roles else None
        renamed = lambda r: F.coalesce(names[r], r) if names is not None else r
        return F.transform(F.col(array), lambda x: _turn(renamed(x.getField(role)), x.getField(text) if f"{array}[].{text}" in have else F.lit(None)))
    given = [F.when(field(p).isNotNull(), _turn(F.lit(role), field(p))) for role, p in layout.turns]
    return F.array_compact(F.array(*given))


def canonical(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with the fingerprint, the layout's name (null: unknown), its canonical ``turns`` and the ``unmapped`` paths."""
    have = _schema_paths(df)
    usable = _usable(layouts, have)
    known = sorted(set().union(*(x.paths() for x in layouts)) & have)
    mark = F.col("_fingerprint")
    name, turns, unmapped = F.lit(None).cast("string"), F.lit(None).cast(TURNS), _filled(known)
    for x, prints in reversed(list(zip(usable, fingerprints(usable), strict=True))):
        if prints:
            its = mark.isin([_hash_paths_literal(p) for p in prints])
            name, turns = F.when(its, F.lit(x.name)).otherwise(name), F.when(its, _mapped(x, have).cast(TURNS)).otherwise(turns)
            unmapped = F.when(its, _filled([p for p in known if p not in x.paths()])).otherwise(unmapped)
    return df.withColumn("_fingerprint", fingerprint(df, layouts)).select("*", name.alias("layout"), turns.alias("turns"), unmapped.alias("unmapped"))


def rejects(rows: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The records without a layout, with the known paths that they fill."""
    return canonical(rows, layouts).where(F.col("layout").isNull()).drop("_fingerprint", "layout", "turns")


def _hash_paths_literal(paths: tuple[str, ...]) -> Column:
    return F.xxhash64(F.lit("\n".join(paths)))


def conversations(rows: DataFrame, id_col: str = "conv_id", order_col: str = "turn", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One row for each id with the turns of all its records in order, null order last, and how many records had no layout."""
    at = F.col(order_col)
    each = canonical(rows, layouts).select(F.col(id_col), F.struct(at.isNull().alias("last"), at.alias("at"), F.col("turns")).alias("x"))
    grouped = each.groupBy(id_col).agg(F.sort_array(F.collect_list("x")).alias("xs"), F.count_if(F.col("x.turns").isNull()).alias("rejected"))
    return grouped.select(id_col, F.flatten(F.transform("xs", lambda x: F.coalesce(x["turns"], F.array().cast(TURNS)))).alias("turns"), "rejected")


#: Order matters: the backslash is escaped first and restored last.
_ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))


def escape(text: Column) -> Column:
    for plain, coded in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(_ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _role_out(role: Column) -> Column:
    return F.coalesce(F.replace(escape(role), F.lit(":"), F.lit("\\c")), F.lit("\\0"))


def _role_in(role: Column) -> Column:
    return F.when(role != "\\0", unescape(F.replace(role, F.lit("\\c"), F.lit(":"))))


def formatted(convs: DataFrame, learn: str = "assistant") -> DataFrame:
    """``convs`` with ``formatted`` and the ``loss_spans`` of the turns whose role is ``learn``."""
    coded = F.transform("turns", lambda t, i: F.struct(i.alias("turn"), F.concat(F.lit(HEAD), _role_out(t["role"]), F.lit(": ")).alias("head"), escape(t["text"]).alias("body"), F.coalesce(t["role"] == learn, F.lit(False)).alias("learn")))
    span = lambda t: F.struct(t["turn"].alias("turn"), F.length(t["head"]).alias("start"), F.length(t["body"]).alias("length"))
    marked = convs.withColumn("_coded", coded)
    text = F.array_join(F.transform("_coded", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    return marked.withColumn("formatted", text).withColumn("loss_spans", F.transform(F.filter("_coded", lambda t: t["learn"]), span)).drop("_coded")


def read_turns(text: Column) -> Column:
    """The turns of a formatted text."""
    parts = F.filter(F.split(text, END), lambda x: x != "")
    role_end = lambda x: F.instr(x, ": ")
    return F.transform(parts, lambda x: F.struct(_role_in(F.substring(x, F.lit(len(HEAD) + 1), role_end(x) - len(HEAD) - 1)).alias("role"), unescape(F.substring(x, role_end(x) + 2, F.length(x))).alias("text")))


def read_loss(text: Column, spans: Column) -> Column:
    """The unescaped texts under the loss mask, joined with nothing between."""
    own = lambda parts: F.transform(spans, lambda s: unescape(F.substring(F.get(parts, s["turn"]), s["start"] + 1, s["length"])))
    return F.transform(F.array(F.split(text, END)), lambda parts: F.array_join(own(parts), ""))[0]
