"""SQL fragments shared by the oracles: the fixed values laid out as lists of slots that a draw indexes.

The Spark code tests a draw against cumulative shares; here each value fills as many slots as its share, so the two agree
only if both follow the definition.
"""

from __future__ import annotations

from stratalake.plans import fixed as V

AS_OF = "2024-02-01"


def drawn(k: str, draw: tuple[int, int]) -> str:
    return f"CAST(({k} * {draw[0]}) % {draw[1]} AS INTEGER)"


def slots(k: str, draw: tuple[int, int], parts: list[tuple[str, int]]) -> str:
    """The SQL value whose slots hold the draw; ``parts``: (SQL value, number of slots)."""
    whole = " || ".join(f"repeat([{value}], {n})" for value, n in parts)
    return f"({whole})[{drawn(k, draw)} + 1]"


def labels(k: str, draw: tuple[int, int], shares: list[tuple[str, int]]) -> str:
    return slots(k, draw, [(f"'{name}'", n) for name, n in shares])


def _tiers(k: str, bucket: tuple[int, int], multiplier: int, tiers: list[tuple[int, int, int]]) -> str:
    """A tier's slots hold its offset and width; the second draw falls within that width."""
    starts = [0, *(t[0] for t in tiers)]
    parts = [(f"[{offset}, {width}]", upto - start) for start, (upto, offset, width) in zip(starts, tiers)]
    tier = slots(k, bucket, parts)
    return f"({tier}[1] + ({k} * {multiplier}) % {tier}[2])"


def birth(k: str) -> str:
    days = _tiers(k, V.SKEWED_BIRTH_BUCKET, V.SKEWED_BIRTH_MULTIPLIER, V.SKEWED_BIRTH_TIERS)
    return (f"if({k} > {V.UNIFORM_BIRTH_LAST_ID}, DATE '{AS_OF}' - CAST({days} AS INTEGER), "
            f"DATE '{V.UNIFORM_BIRTH_START}' + {drawn(k, V.UNIFORM_BIRTH_DRAW)})")


def age(k: str) -> str:
    return f"CAST(floor(date_diff('day', {birth(k)}, DATE '{AS_OF}') / 365.25) AS INTEGER)"


def age_band(a: str) -> str:
    """The label at the number of lower limits that the age has reached."""
    reached = " + ".join(f"CAST({a} >= {limit} AS INTEGER)" for limit in (18, 35, 50, 65))
    return f"['0-17', '18-34', '35-49', '50-64', '65+'][1 + {reached}]"


def sex(k: str) -> str:
    return f"{strings(V.SEXES)}[{drawn(k, V.SEX_DRAW)} + 1]"


def status(k: str) -> str:
    return labels(k, V.STATUS_DRAW, V.STATUS_SHARES)


def mode(k: str) -> str:
    return labels(k, V.MODE_DRAW, V.MODE_SHARES)


def plan(k: str) -> str:
    return labels(k, V.PLAN_DRAW, V.PLAN_SHARES)


def marital(k: str) -> str:
    return labels(k, V.MARITAL_DRAW, V.MARITAL_SHARES)


def channel(k: str) -> str:
    return labels(k, V.CHANNEL_DRAW, V.CHANNEL_SHARES)


def wait(k: str) -> str:
    parts = " + ".join(f"({k} * {m}) % {n}" for m, n in V.WAIT_DRAWS)
    return f"({parts}) * CAST({status(k)} <> '{V.CANCELLED}' AS INTEGER)"


def procedure(k: str) -> str:
    by_mode = f"{strings([V.PROCEDURE_RETURN, V.PROCEDURE_TELE])}[list_position(['retorno', 'telemedicina'], {mode(k)})]"
    return f"if({status(k)} <> '{V.CANCELLED}', coalesce({by_mode}, {labels(k, V.PROCEDURE_DRAW, V.PROCEDURE_SHARES)}), NULL)"


def delay(k: str) -> str:
    return _tiers(k, V.DELAY_BUCKET, V.DELAY_MULTIPLIER, [(upto, offset, width) for upto, width, offset in V.DELAY_TIERS])


def review_class(w: str, seq: str) -> str:
    """One slot list for each waiting band, taken by the number of limits passed."""
    lists = ", ".join(labels(seq, V.CLASS_DRAW, shares) for _, _, shares in V.CLASS_BY_WAIT)
    (_, first, _), (_, second, _), _ = V.CLASS_BY_WAIT
    return f"[{lists}][1 + CAST({w} >= {first} AS INTEGER) + CAST({w} > {second} AS INTEGER)]"


def _filled(k: str, template: str, groups: list[tuple[int, int, int]]) -> str:
    for _, _, width in groups:
        template = template.replace("{}", "{:0%dd}" % width, 1)
    return f"format('{template}', {', '.join(f'({k} * {m}) % {n}' for m, n, _ in groups)})"


def tax_id(k: str) -> str:
    return _filled(k, *V.TAX_ID)


def health_card(k: str) -> str:
    return _filled(k, *V.HEALTH_CARD)


def registry_id(k: str) -> str:
    return _filled(k, *V.REGISTRY_ID)


def phone(k: str) -> str:
    area = f"{strings(V.AREA_CODES)}[{drawn(k, (V.AREA_CODE_MULTIPLIER, len(V.AREA_CODES)))} + 1]"
    return f"('(' || {area} || ') ' || {_filled(k, *V.PHONE)})"


def licence(k: str) -> str:
    state = f"{strings(V.LICENCE_STATES)}[{drawn(k, (V.LICENCE_STATE_MULTIPLIER, len(V.LICENCE_STATES)))} + 1]"
    return f"format('CRM/{{}} {{:06d}}', {state}, {V.LICENCE_NUMBER_START} + {drawn(k, V.LICENCE_NUMBER_DRAW)})"


def strings(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def element(values, k: str, multiplier: int) -> str:
    return f"{strings(sorted(values))}[CAST(({k} * {multiplier}) % {len(values)} AS INTEGER) + 1]"


def money(expression: str) -> str:
    return f"CAST(sum(CAST({expression} AS DECIMAL(18,2))) AS DOUBLE)"


def word_scores(lexicon: dict[str, int]) -> str:
    return "(VALUES " + ", ".join(f"('{w}', {s})" for w, s in lexicon.items()) + ") AS lex(w, s)"


def document_scores(lexicon: dict[str, int]) -> str:
    """A query of doc_id and lexicon score for every document."""
    return f"""SELECT d.doc_id, CAST(coalesce(sum(lex.s), 0) AS BIGINT) AS score
      FROM (SELECT doc_id, unnest(list_append(string_split_regex(lower(text), '[^\\p{{L}}]+'), '')) AS w FROM documents) d
      LEFT JOIN {word_scores(lexicon)} ON lex.w = d.w GROUP BY d.doc_id"""


def polarity(score: str) -> str:
    return f"CASE WHEN {score} > 0 THEN 'positive' WHEN {score} < 0 THEN 'negative' ELSE 'neutral' END"
