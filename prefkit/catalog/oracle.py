"""The catalogued queries in plain SQL, with global windows and no care for scale.

Written for DuckDB over views named like the data files.
"""

from __future__ import annotations

from prefkit.sources.questions import COMMON_QUESTIONS

BLANKS = r"[\t\n\x0B\f\r \p{Z}]+"
SPECIALS = ("<|endoftext|>", "<unk>", "<|im_start|>", "<|im_end|>", "<think>", "</think>")
SYSTEM = "You are a helpful assistant."

_MARK = "|".join(s.replace("|", r"\|") for s in SPECIALS)
_SPECIAL_LIST = "[" + ", ".join(f"'{s}'" for s in SPECIALS) + "]"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex({text}, '{BLANKS}'), lambda w: w <> '')"


def _chat_words(text: str) -> str:
    return _words(f"regexp_replace({text}, '({_MARK})', ' \\1 ', 'g')")


def _message(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


def _prompt(question: str, system: str = SYSTEM) -> str:
    return f"{_message('system', repr(system))} || {_message('user', question)}"


def _opened(question: str) -> str:
    return f"{_prompt(question)} || '<|im_start|>assistant' || chr(10)"


def _talk(question: str, answer: str, system: str = SYSTEM) -> str:
    return f"{_prompt(question, system)} || {_message('assistant', answer)}"


def _place(seed: str = "42", key: str = "row_id") -> str:
    return f"row_number() OVER (ORDER BY md5('{seed}|' || {key}), {key})"


def _split(fraction: float, seed: str = "42") -> str:
    return (
        f"CASE WHEN {_place(seed)} <= ceil({fraction}::DOUBLE * count(*) OVER ()) THEN 'test' ELSE 'train' END"
    )


def _draw(*parts: str) -> str:
    text = " || '|' || ".join(parts)
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _str(items: str) -> str:
    return f"array_to_string({items}, ' ')"


def _mean(where: str = "true") -> str:
    """The mean weight, summed in billionths so that the order of rows cannot matter."""
    return (
        f"(sum(coalesce(round(weight * 1000000000)::BIGINT, 0)) FILTER ({where}))::DOUBLE"
        f" / (count(*) FILTER ({where}))::DOUBLE / 1000000000"
    )


# Named parts of queries, each listing the parts it reads.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {
    "ex0": ((), """
        SELECT a.conv_id * 4294967296 + a.turn AS row_id, a.conv_id, a.turn, a.text AS question, b.text AS answer
        FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
        WHERE a.role = 'user' AND b.role = 'assistant'"""),
    "ex": (("ex0",), """
        SELECT e.*, coalesce(n.answer, e.answer) AS other
        FROM ex0 e LEFT JOIN ex0 n ON n.conv_id = e.conv_id AND n.turn = e.turn + 2"""),
    "lab": ((), r"""
        SELECT doc_id, lang, text, quality,
               row_number() OVER (PARTITION BY lang, quality ORDER BY md5('pair|' || doc_id), doc_id) - 1 AS r
        FROM documents JOIN labels USING (doc_id)
        WHERE regexp_matches(text, '\S') AND quality IN (0, 1)"""),
    "prefs": (("lab",), f"""
        SELECT c.doc_id AS row_id, q.question, c.text AS chosen, b.text AS rejected, b.doc_id AS rejected_id
        FROM lab c
        JOIN (SELECT lang, count(*) AS n_bad FROM lab WHERE quality = 0 GROUP BY lang) n ON n.lang = c.lang
        JOIN lab b ON b.lang = c.lang AND b.quality = 0 AND b.r = c.r % n.n_bad
        JOIN (SELECT text AS question, {_place('pair', 'item_id')} - 1 AS q, count(*) OVER () AS n_q FROM benchmark) q
          ON q.q = c.r % q.n_q
        WHERE c.quality = 1"""),
    "talks": (("prefs",), f"""
        SELECT row_id, {_talk('question', 'chosen')} AS chosen, {_talk('question', 'rejected')} AS rejected,
               {_split(0.05)} AS split, {_place()} AS place
        FROM prefs"""),
    "sides": (("talks",), f"""
        SELECT row_id, split, place, 'chosen' AS side, {_chat_words('chosen')} AS w FROM talks
        UNION ALL
        SELECT row_id, split, place, 'rejected' AS side, {_chat_words('rejected')} AS w FROM talks"""),
    "odds": (("sides",), """
        SELECT tok, c, r, round(ln((c + 1)::DOUBLE / (r + 1)), 9) AS weight
        FROM (SELECT tok, count(*) FILTER (side = 'chosen') AS c, count(*) FILTER (side = 'rejected') AS r
              FROM (SELECT side, unnest(w) AS tok FROM sides WHERE split = 'train') GROUP BY tok)"""),
    "side_scores": (("sides", "odds"), f"""
        SELECT row_id, side, {_mean()} AS score
        FROM (SELECT row_id, side, unnest(w) AS tok FROM sides) LEFT JOIN odds USING (tok)
        GROUP BY row_id, side"""),
    "scored": (("side_scores",), """
        SELECT row_id, max(score) FILTER (side = 'chosen') AS chosen_score,
               max(score) FILTER (side = 'rejected') AS rejected_score
        FROM side_scores GROUP BY row_id"""),
    "voc": ((), f"""
        SELECT tok, cnt, row_number() OVER (ORDER BY cnt DESC, tok) + {len(SPECIALS) - 1} AS id
        FROM (SELECT tok, count(*) AS cnt FROM (SELECT unnest({_chat_words('text')}) AS tok FROM documents)
              WHERE NOT list_contains({_SPECIAL_LIST}, tok) GROUP BY tok)"""),
    "ids_of": (("voc",), f"""
        SELECT tok, id FROM voc
        UNION ALL SELECT unnest({_SPECIAL_LIST}), unnest(range({len(SPECIALS)}))"""),
    "ex_words": (("ex",), f"""
        SELECT row_id, {_chat_words(_opened('question'))} AS p, {_chat_words('answer')} AS a FROM ex"""),
    "asked": (("ex",), """
        SELECT 'sample' AS source, row_id, question, answer AS sft_response, other AS ppo_response FROM ex
        UNION ALL
        SELECT 'common', item_id, b.text, coalesce(d.text, ''), coalesce(e.text, '')
        FROM benchmark b LEFT JOIN documents d ON d.doc_id = item_id LEFT JOIN documents e ON e.doc_id = item_id + 1"""),
    "compared": (("asked", "odds"), f"""
        SELECT source, row_id, question, sft_response, ppo_response, sft_rm_score, ppo_rm_score,
               ppo_rm_score - sft_rm_score AS score_diff
        FROM asked JOIN (
            SELECT source, row_id, {_mean("m = 'sft'")} AS sft_rm_score,
                   {_mean("m = 'ppo'")} AS ppo_rm_score
            FROM (SELECT source, row_id, 'sft' AS m, unnest({_chat_words(_talk('question', 'sft_response', ''))}) AS tok FROM asked
                  UNION ALL
                  SELECT source, row_id, 'ppo', unnest({_chat_words(_talk('question', 'ppo_response', ''))}) FROM asked)
            LEFT JOIN odds USING (tok) GROUP BY source, row_id) USING (source, row_id)"""),
    "train": (("ex",), f"""
        SELECT *, {_place()} - 1 AS pos FROM (SELECT *, {_split(0.1)} AS split FROM ex) WHERE split = 'train'"""),
    "picks": (("train", "n_train"), f"""
        SELECT step, 0::BIGINT AS slot, [{_draw("'row'", "'42'", "step", "'0'")} % n] AS taken
        FROM range(200) t(step), n_train
        UNION ALL
        SELECT step, slot + 1, list_append(taken, list_reduce(
                   list_prepend({_draw("'row'", "'42'", "step", "(slot + 1)")} % (n - slot - 1), list_sort(taken)),
                   lambda p, t: CASE WHEN t <= p THEN p + 1 ELSE p END))
        FROM picks, n_train WHERE slot < 7"""),
    "n_train": (("train",), "SELECT count(*) AS n FROM train"),
    "drawn": (("picks", "train"), f"""
        SELECT step, slot, row_id, 32 + {_draw("'len'", "'42'", "step", "slot")} % 224 AS gen_len,
               {_opened('question')} AS query, answer, other, question
        FROM picks JOIN train ON pos = taken[slot + 1]"""),
    "rolls": (("drawn", "odds"), f"""
        SELECT step, slot, row_id, gen_len, query, response, reward, run_id
        FROM (SELECT *, {_str(f"list_slice({_words('words_from')}, 1, gen_len)")} AS response
              FROM (SELECT *, 'run' AS run_id, answer AS words_from FROM drawn
                    UNION ALL SELECT *, 'b', other FROM drawn))
        JOIN (SELECT run_id, step, slot, ({_mean()})::FLOAT::DOUBLE AS reward
              FROM (SELECT run_id, step, slot, unnest(list_filter({_chat_words(f"query || ' ' || {_str(f'list_slice({_words('words_from')}, 1, gen_len)')}")},
                                                          lambda w: NOT list_contains({_SPECIAL_LIST}, w))) AS tok
                    FROM (SELECT *, 'run' AS run_id, answer AS words_from FROM drawn
                          UNION ALL SELECT *, 'b', other FROM drawn))
              LEFT JOIN odds USING (tok) GROUP BY run_id, step, slot) USING (run_id, step, slot)"""),
    "steps": (("rolls",), """
        SELECT run_id, step, count(*) AS n, avg(reward) AS mean_reward FROM rolls GROUP BY run_id, step"""),
}


def _with(body: str, *parts: str) -> str:
    """The body behind the parts it names and theirs."""
    order: list[str] = []

    def add(name: str) -> None:
        if name not in order:
            for needed in PARTS[name][0]:
                add(needed)
            order.append(name)

    for part in parts:
        add(part)
    ctes = ",\n".join(f"{name} AS ({PARTS[name][1]})" for name in order)
    return f"WITH RECURSIVE {ctes}\n{body}" if order else body


def _messages(source: str, keys: str, contents: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {keys}, {i}::BIGINT AS idx, '{role}' AS role, {content} AS content FROM {source}"
        for i, (role, content) in enumerate(contents)
    )


def _encoded(source: str, key: str, words: str, limit: int | None = None) -> str:
    """row_id, ids, mask, n_ids and was_truncated of a word list."""
    cut = "false" if limit is None else f"len({words}) > {limit}"
    head = words if limit is None else f"list_slice({words}, 1, {limit})"
    return f"""
        SELECT row_id, coalesce(string_agg(coalesce(id, 1)::VARCHAR, ' ' ORDER BY pos) FILTER (tok IS NOT NULL), '') AS ids,
               coalesce(string_agg('1', ' ' ORDER BY pos) FILTER (tok IS NOT NULL), '') AS mask,
               count(tok) AS n_ids, bool_or(cut) AS was_truncated
        FROM (SELECT row_id, cut, unnest(CASE WHEN len(w) = 0 THEN [NULL] ELSE w END) AS tok,
                     unnest(CASE WHEN len(w) = 0 THEN [0] ELSE range(len(w)) END) AS pos
              FROM (SELECT {key} AS row_id, {cut} AS cut, {head} AS w FROM {source}))
        LEFT JOIN ids_of USING (tok) GROUP BY row_id"""


_EX_IDS = f"({_encoded('ex_words', 'row_id', 'p')}) p JOIN ({_encoded('ex_words', 'row_id', 'a')}) a USING (row_id)"
_FULL = "trim(p.ids || ' ' || a.ids)"
_BATCHED = f"""(SELECT row_id, ({_place()} - 1) // 8 AS batch_id, p.ids, p.n_ids
               FROM ({_encoded('ex_words', 'row_id', 'p')}) p)"""
_SYS = f"'{SYSTEM}'"
_PAIRED = "sft_rm_score IS NOT NULL AND ppo_rm_score IS NOT NULL"
_SUMMARY = f"""count(*) AS n, count(sft_rm_score) AS n_answered_a, count(ppo_rm_score) AS n_answered_b, count(*) FILTER ({_PAIRED}) AS n_paired,
       round(avg(sft_rm_score) FILTER ({_PAIRED}), 6) AS mean_a, round(avg(ppo_rm_score) FILTER ({_PAIRED}), 6) AS mean_b,
       round(avg(ppo_rm_score) FILTER ({_PAIRED}) - avg(sft_rm_score) FILTER ({_PAIRED}), 6) AS lift, count(*) FILTER (ppo_rm_score > sft_rm_score) AS wins,
       round(100.0::DOUBLE * count(*) FILTER (ppo_rm_score > sft_rm_score) / count(*) FILTER ({_PAIRED}), 6) AS win_rate"""
# Left out answers: the score of an empty place is missing.
_GAPS = """(SELECT * REPLACE (CASE WHEN a THEN sft_response END AS sft_response, CASE WHEN b THEN ppo_response END AS ppo_response,
              CASE WHEN a THEN sft_rm_score END AS sft_rm_score, CASE WHEN b THEN ppo_rm_score END AS ppo_rm_score, CASE WHEN a AND b THEN score_diff END AS score_diff)
            FROM (SELECT *, ('0x' || substr(md5('sft|' || row_id), 1, 8))::BIGINT % 10 < 8 AS a, ('0x' || substr(md5('ppo|' || row_id), 1, 8))::BIGINT % 10 < 7 AS b FROM compared))"""
_NO_THINK = "'<think>' || repeat(chr(10), 2) || '</think>' || repeat(chr(10), 2)"
# Conversations that say the stop word, and the turn at which they do.
_STOPPING = """(SELECT * REPLACE (CASE WHEN role = 'user' AND turn = 2 AND conv_id % 5 = 0 THEN ' Exit' || chr(10) ELSE text END AS text) FROM conversations)"""
_SESSIONS = rf"""SELECT t.* FROM {_STOPPING} t LEFT JOIN (SELECT conv_id, min(turn) AS stop FROM {_STOPPING}
            WHERE role = 'user' AND lower(regexp_replace(text, '^[\s\x0B\p{{Z}}]+|[\s\x0B\p{{Z}}]+$', '', 'g')) = 'exit' GROUP BY conv_id) s
            ON t.conv_id = s.conv_id WHERE stop IS NULL OR turn < stop"""
# The reward as a kernel machine: weights are a sum of the train pairs' vectors, found by plain gradient descent on its coefficients.
_REWARD = f"""
    places AS MATERIALIZED (SELECT row_id, side, split, ('0x' || substr(md5(tok), 1, 8))::BIGINT % 16384 AS place, count(*)::DOUBLE AS n
        FROM (SELECT row_id, side, split, unnest({_words('text')}) AS tok FROM (SELECT row_id, split, 'chosen' AS side, chosen AS text FROM talks
              UNION ALL SELECT row_id, split, 'rejected', rejected FROM talks)) GROUP BY ALL),
    unit AS MATERIALIZED (SELECT row_id, side, split, place, n / sqrt(sum(n * n) OVER (PARTITION BY row_id, side)) AS v FROM places),
    train_pairs AS MATERIALIZED (SELECT row_id, row_number() OVER (ORDER BY row_id) AS i FROM talks WHERE split = 'train'),
    pair AS MATERIALIZED (SELECT i, place, sum(CASE side WHEN 'chosen' THEN v ELSE -v END) AS v FROM unit JOIN train_pairs USING (row_id) GROUP BY i, place),
    gram AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.v * b.v) AS k FROM pair a JOIN pair b USING (place) GROUP BY a.i, b.i),
    kernel AS MATERIALIZED (SELECT list(r ORDER BY i) AS k, count(*) AS m FROM (SELECT x.i, list(coalesce(k, 0.0) ORDER BY y.i) AS r
        FROM train_pairs x CROSS JOIN train_pairs y LEFT JOIN gram ON gram.i = x.i AND gram.j = y.i GROUP BY x.i)),
    descent AS (SELECT 0 AS t, list_transform(range(m), lambda x: 0.0::DOUBLE) AS a FROM kernel
        UNION ALL SELECT t + 1, list_transform(range(1, m + 1), lambda i: a[i] * (1 - 1.5 * 0.1) + 1.5 / m / (1 + exp(list_dot_product(k[i], a))))
        FROM descent, kernel WHERE t < 150),
    coefficient AS (SELECT unnest(a) AS a, unnest(range(1, len(a) + 1)) AS i FROM descent WHERE t = 150),
    weight AS MATERIALIZED (SELECT place, sum(a * v) AS w FROM pair JOIN coefficient USING (i) GROUP BY place),
    judged AS (SELECT row_id, coalesce(sum(v * w) FILTER (side = 'chosen'), 0) AS chosen_score, coalesce(sum(v * w) FILTER (side = 'rejected'), 0) AS rejected_score
        FROM unit LEFT JOIN weight USING (place) WHERE split = 'test' GROUP BY row_id)
"""
_RESULT = """question, sft_response, ppo_response, round(sft_rm_score, 6) AS sft_rm_score,
       round(ppo_rm_score, 6) AS ppo_rm_score, round(score_diff, 6) AS score_diff"""
_SPACING = "((length({0}) - length(replace({0}, ' ', '')))::DOUBLE / greatest(length({0}), 1))::FLOAT::DOUBLE"
_STEP = "run_id, step, n, round(mean_reward, 4) AS mean_reward"


def _accuracy(source: str) -> str:
    return f"""SELECT count(*) AS total, count(*) FILTER (chosen_score > rejected_score) AS correct,
       100.0::DOUBLE * count(*) FILTER (chosen_score > rejected_score) / count(*) AS accuracy FROM {source}"""


def _refit(source: str, keep: str, cut: int | None = None) -> str:
    """Accuracy after fitting the word weights on the train side of ``source`` (row_id, question, chosen, rejected)."""
    w = lambda t: _chat_words(t) if cut is None else f"list_slice({_chat_words(t)}, 1, {cut})"
    return f"""
    WITH RECURSIVE t AS (SELECT row_id, {_split(0.05)} AS split, {_place()} AS place,
                     {w(_talk('question', 'chosen'))} AS cw, {w(_talk('question', 'rejected'))} AS rw FROM {source}),
    s AS (SELECT row_id, split, place, 1 AS c, unnest(cw) AS tok FROM t
          UNION ALL SELECT row_id, split, place, 0, unnest(rw) FROM t),
    o AS (SELECT tok, round(ln((sum(c) + 1)::DOUBLE / (count(*) - sum(c) + 1)), 9) AS weight FROM s WHERE split = 'train' GROUP BY tok),
    f AS (SELECT row_id, {_mean("c = 1")} AS chosen_score,
                 {_mean("c = 0")} AS rejected_score
          FROM s LEFT JOIN o USING (tok) WHERE {keep} GROUP BY row_id)
    {_accuracy('f')}"""


def oracle_sql() -> dict[str, str]:
    rounded = "round(chosen_score, 6) AS chosen_score, round(rejected_score, 6) AS rejected_score"
    pair_ids = "({}) c JOIN ({}) r USING (row_id)"
    full_pairs = pair_ids.format(
        _encoded("(SELECT * FROM sides WHERE side = 'chosen')", "row_id", "w"),
        _encoded("(SELECT * FROM sides WHERE side = 'rejected')", "row_id", "w"),
    )
    cut_pairs = pair_ids.format(
        _encoded("(SELECT * FROM sides WHERE side = 'chosen')", "row_id", "w", 512),
        _encoded("(SELECT * FROM sides WHERE side = 'rejected')", "row_id", "w", 512),
    )
    return {
        "scan_preferences": _with(
            f"SELECT row_id, question, chosen, rejected FROM (SELECT *, {_split(0.05)} AS split FROM prefs) WHERE split = 'train'", "prefs"
        ),
        "scan_unkeyed_preferences": _with("SELECT question, chosen, rejected FROM prefs", "prefs"),
        "read_responses": _with("SELECT row_id, question, answer AS response FROM ex", "ex"),
        "csv_round_trip": _with(
            f"SELECT * REPLACE (nullif(sft_response, '') AS sft_response, nullif(ppo_response, '') AS ppo_response) FROM (SELECT {_RESULT} FROM compared)",
            "compared",
        ),
        "step_metrics_log": _with(
            "SELECT CASE run_id WHEN 'run' THEN 'a' ELSE 'b' END AS run_id, step, n, round(mean_reward, 6) AS mean_reward FROM steps", "steps"
        ),
        "export_pairs": _with(
            f"""SELECT row_id, (row_number() OVER (PARTITION BY split ORDER BY md5('42|' || row_id), row_id) - 1) // 32 AS batch_id, split, c.ids AS chosen, r.ids AS rejected
            FROM {full_pairs} JOIN talks USING (row_id)""",
            "talks", "sides", "ids_of",
        ),
        "messages_sft": _with(
            _messages("prefs", "row_id", [("system", _SYS), ("user", "question"), ("assistant", "chosen")]), "prefs"
        ),
        "messages_pairs": _with(
            "\nUNION ALL\n".join(
                _messages("prefs", f"row_id, '{s}' AS side", [("system", _SYS), ("user", "question"), ("assistant", s)])
                for s in ("chosen", "rejected")
            ),
            "prefs",
        ),
        "messages_prompt": _with(_messages("ex", "row_id", [("system", _SYS), ("user", "question")]), "ex"),
        "messages_scoring": _with(
            _messages("ex", "row_id", [("system", "''"), ("user", "question"), ("assistant", "answer")]), "ex"
        ),
        "render_chat": _with("SELECT row_id, chosen AS chosen_text, rejected AS rejected_text FROM talks", "talks"),
        "render_prompt": _with(f"SELECT row_id, {_opened('question')} AS prompt FROM ex", "ex"),
        "render_no_think": _with(
            f"SELECT row_id, {_opened('question')} || '<think>' || repeat(chr(10), 2) || '</think>' || repeat(chr(10), 2) AS prompt FROM ex", "ex"
        ),
        "trimmed_texts": rf"""SELECT conv_id, turn, lower(t) AS trimmed, lower(t) = 'exit' AS stops,
            CASE WHEN role = 'system' OR text = '' THEN {_SYS} ELSE text END AS filled
            FROM (SELECT *, regexp_replace(text, '^[\s\x0B\p{{Z}}]+|[\s\x0B\p{{Z}}]+$', '', 'g') AS t FROM conversations)""",
        "split_ordered": _with(
            """SELECT row_id, CASE WHEN row_number() OVER (ORDER BY row_id) > count(*) OVER () - ceil(0.1::DOUBLE * count(*) OVER ())
            THEN 'test' ELSE 'train' END AS split FROM ex""",
            "ex",
        ),
        "split_seeded_5": _with(f"SELECT row_id, {_split(0.05)} AS split FROM prefs", "prefs"),
        "split_seeded_10": _with(f"SELECT row_id, {_split(0.1)} AS split FROM ex", "ex"),
        "split_replay": _with(
            f"""SELECT split_5, split_5 AS replayed, split_10, count(*) AS n
            FROM (SELECT {_split(0.05)} AS split_5, {_split(0.1)} AS split_10 FROM prefs) GROUP BY ALL""",
            "prefs",
        ),
        "split_sides": _with(
            f"""SELECT split, count(*) AS n, sum(length(chosen) + length(rejected))::BIGINT AS chars
            FROM (SELECT *, {_split(0.05)} AS split FROM prefs) GROUP BY split""",
            "prefs",
        ),
        "eval_head_100": _with(
            f"""SELECT row_id, question FROM ex QUALIFY {_place()} <= least(100, ceil(0.5::DOUBLE * count(*) OVER ()))""", "ex"
        ),
        "sample_questions": _with(f"SELECT row_id, question FROM ex QUALIFY {_place()} <= 50", "ex"),
        "union_common": _with(
            "SELECT 'sample' AS source, row_id, question FROM ex UNION ALL SELECT * FROM (VALUES "
            + ", ".join(f"('common', {i}::BIGINT, '{q}')" for i, q in enumerate(COMMON_QUESTIONS, 1))
            + ")",
            "ex",
        ),
        "vocab": _with("SELECT tok, cnt, id FROM voc", "voc"),
        "encode_documents": _with(_encoded("documents", "doc_id", _chat_words("text")), "ids_of"),
        "encode_truncated": _with(
            "\nUNION ALL\n".join(
                f"SELECT *, '{side}' AS side FROM ({_encoded(f'(SELECT * FROM sides WHERE side = {side!r})', 'row_id', 'w', 512)})" for side in ("chosen", "rejected")
            ),
            "sides", "ids_of",
        ),
        "decode_texts": _with(
            f"""SELECT row_id, side, coalesce(string_agg(t, ' ' ORDER BY pos), '') AS kept,
                   coalesce(string_agg(t, ' ' ORDER BY pos) FILTER (NOT list_contains({_SPECIAL_LIST}, t)), '') AS plain
            FROM (SELECT row_id, side, pos, CASE WHEN id IS NULL THEN '<unk>' ELSE tok END AS t
                  FROM (SELECT row_id, side, unnest(w) AS tok, unnest(range(len(w))) AS pos FROM sides)
                  LEFT JOIN ids_of USING (tok)) GROUP BY row_id, side""",
            "sides", "ids_of",
        ),
        "prompt_response_concat": _with(
            f"""SELECT row_id, {_FULL} AS full_ids,
            {_str(f"list_filter(string_split({_FULL}, ' '), lambda i: i::BIGINT >= {len(SPECIALS)})")} AS plain_ids FROM {_EX_IDS}""",
            "ex_words", "ids_of",
        ),
        "strip_prompt": _with(_encoded("ex_words", "row_id", "a").replace("AS ids", "AS new_ids", 1).join(["SELECT row_id, new_ids FROM (", ")"]), "ex_words", "ids_of"),
        "pad_batch": _with(
            f"""SELECT row_id, batch_id, trim(ids || repeat(' 0', width - n_ids)) AS ids,
            trim(repeat('1 ', n_ids) || repeat('0 ', width - n_ids)) AS mask
            FROM (SELECT *, max(n_ids) OVER (PARTITION BY batch_id) AS width FROM {_BATCHED})""",
            "ex_words", "ids_of",
        ),
        "batch_widths": _with(f"SELECT batch_id, max(n_ids) AS width FROM {_BATCHED} GROUP BY batch_id", "ex_words", "ids_of"),
        "micro_batches": _with(
            """SELECT row_id, pos, pos // 4 AS micro_batch, pos // 32 AS batch_id
            FROM (SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS pos FROM ex)""",
            "ex",
        ),
        "token_log_odds": _with("SELECT tok, c, r, round(weight, 6) AS weight FROM odds", "odds"),
        "score_preferences": _with(f"SELECT row_id, {rounded} FROM scored", "scored"),
        "score_float32": _with("SELECT row_id, round(chosen_score::FLOAT::DOUBLE, 4) AS reward FROM scored", "scored"),
        "pairwise_labels": _with(
            """SELECT row_id, place AS sample_no, printf('%.4f', chosen_score) AS chosen_score,
            printf('%.4f', rejected_score) AS rejected_score,
            CASE WHEN scored.chosen_score > scored.rejected_score THEN 'Correct' ELSE 'Incorrect' END AS verdict
            FROM scored JOIN talks USING (row_id) WHERE split = 'test'""",
            "talks", "scored",
        ),
        "pairwise_accuracy": _with(
            _accuracy("scored JOIN (SELECT row_id, split FROM talks) USING (row_id) WHERE split = 'test'"), "talks", "scored"
        ),
        "pairwise_accuracy_first": _refit(f"({_with('SELECT * FROM prefs', 'prefs')})", "split = 'test' AND place <= 100", 512),
        "pairwise_accuracy_hard": _refit(
            f"({_with('SELECT row_id, question, answer AS chosen, other AS rejected FROM ex', 'ex')})", "split = 'test'"
        ),
        "pairwise_loss": _with(
            """SELECT round(rank_loss, 6) AS rank_loss, round(center_loss, 6) AS center_loss, round(rank_loss + center_loss, 6) AS loss
            FROM (SELECT avg(ln(1 + exp(rejected_score - chosen_score))) AS rank_loss,
                         0.01::DOUBLE * avg((chosen_score + rejected_score) * (chosen_score + rejected_score)) AS center_loss FROM scored)""",
            "scored",
        ),
        "bradley_terry": _with("SELECT 1", "talks").rsplit("SELECT 1", 1)[0].rstrip()
        + ","
        + _REWARD
        + """SELECT count(*) AS total, count(*) FILTER (chosen_score > rejected_score) AS correct,
            100.0::DOUBLE * count(*) FILTER (chosen_score > rejected_score) / count(*) AS accuracy,
            round(avg(chosen_score - rejected_score), 3) AS mean_margin, true AS optimal FROM judged""",
        "encode_with_hook": """SELECT conv_id, turn, length(text) AS n_ids,
            coalesce(list_sum(list_transform(string_split(text, ''), lambda c: unicode(c))), 0)::BIGINT AS total FROM conversations""",
        "batch_udf_scores": f"SELECT doc_id, round({_SPACING.format('text')}, 4) AS score FROM documents",
        "compare_rows": _with(f"SELECT source, row_id, {_RESULT} FROM compared", "compared"),
        "compare_summary": _with(f"SELECT {_SUMMARY} FROM compared", "compared"),
        "summary_text": _with(
            """SELECT 'Questions: ' || count(*) || chr(10) || 'Mean SFT score: ' || printf('%.4f', avg(sft_rm_score)) || chr(10)
            || 'Mean PPO score: ' || printf('%.4f', avg(ppo_rm_score)) || chr(10)
            || 'Lift: ' || printf('%.4f', avg(ppo_rm_score) - avg(sft_rm_score)) || chr(10)
            || 'PPO wins: ' || count(*) FILTER (ppo_rm_score > sft_rm_score) || chr(10)
            || 'Win rate: ' || printf('%.2f%%', count(*) FILTER (ppo_rm_score > sft_rm_score) * 100.0::DOUBLE / count(*)) AS report
            FROM compared""",
            "compared",
        ),
        "compare_with_gaps": _with(
            f"SELECT source, {_SUMMARY} FROM {_GAPS} GROUP BY source UNION ALL SELECT 'all', {_SUMMARY} FROM {_GAPS}", "compared"
        ),
        "compare_rows_with_gaps": _with(f"SELECT source, row_id, {_RESULT} FROM {_GAPS}", "compared"),
        "compare_by_source": _with(f"SELECT source, {_SUMMARY} FROM compared GROUP BY source", "compared"),
        "compare_sample_50": _with(
            f"""SELECT {_SUMMARY} FROM (
                SELECT {_SPACING.format('a')} AS sft_rm_score, {_SPACING.format('b')} AS ppo_rm_score
                FROM (SELECT {_talk('question', 'sft_response', '')} AS a, {_talk('question', 'ppo_response', '')} AS b
                      FROM (SELECT * FROM asked WHERE source = 'common'
                            UNION ALL (SELECT * FROM asked WHERE source = 'sample' QUALIFY {_place()} <= 50))))""",
            "asked",
        ),
        "compare_long": _with(
            """SELECT source, row_id, question, 'sft' AS model, sft_response AS response, round(sft_rm_score, 6) AS score, NULL::DOUBLE AS lift FROM compared
            UNION ALL SELECT source, row_id, question, 'ppo', ppo_response, round(ppo_rm_score, 6), round(score_diff, 6) FROM compared""",
            "compared",
        ),
        "compare_wide": _with("SELECT source, row_id, round(sft_rm_score, 6) AS sft, round(ppo_rm_score, 6) AS ppo FROM compared", "compared"),
        "compare_common": _with(
            """SELECT row_number() OVER (ORDER BY row_id) AS question_no, question,
            'SFT: ' || sft_response || chr(10) || 'SFT score: ' || printf('%.4f', sft_rm_score) || chr(10)
            || 'PPO: ' || ppo_response || chr(10) || 'PPO score: ' || printf('%.4f', ppo_rm_score) || chr(10)
            || 'Difference: ' || printf('%.4f', score_diff) AS report
            FROM compared WHERE source = 'common'""",
            "compared",
        ),
        "rollout_prompts": _with("SELECT step, slot, slot // 2 AS mini_batch, row_id, gen_len, query FROM drawn", "drawn"),
        "length_draws": f"SELECT conv_id, turn, 32 + {_draw(chr(39) + 'len' + chr(39), chr(39) + '42' + chr(39), 'conv_id', 'turn')} % 224 AS gen_len FROM conversations",
        "rollout_table": _with(
            "SELECT run_id, step, slot, row_id, gen_len, query, response, round(reward, 4) AS reward FROM rolls WHERE run_id = 'run'", "rolls"
        ),
        "step_rewards": _with(f"SELECT {_STEP} FROM steps WHERE run_id = 'run'", "steps"),
        "step_progress": _with(f"SELECT {_STEP} FROM steps WHERE run_id = 'run' AND step % 10 = 0", "steps"),
        "snapshot_steps": _with(
            f"SELECT step + 1 AS snapshot, {_STEP} FROM steps WHERE run_id = 'run' AND (step + 1) % 50 = 0", "steps"
        ),
        "generate_responses": _with(
            f"""SELECT row_id, {_str(f"list_slice(list_reverse(string_split(question, ' ')), 1, 2 + {_draw(chr(39) + 'len' + chr(39), chr(39) + '42' + chr(39), 'conv_id', 'turn')} % 14)")} AS response FROM ex""",
            "ex",
        ),
        "generated_rollouts": _with(
            f"""SELECT 'run' AS run_id, step, count(*) AS n, round(avg({_SPACING.format('text')}), 4) AS mean_reward
            FROM (SELECT step, {_str(f"list_filter({_chat_words(f"query || ' ' || {_str('list_slice(list_reverse(string_split(query, chr(32))), 1, gen_len)')}")}, lambda w: NOT list_contains({_SPECIAL_LIST}, w))")} AS text FROM drawn)
            GROUP BY step""",
            "drawn",
        ),
        "build_sft_set": _with(
            _messages(
                """(SELECT *, CASE WHEN row_number() OVER (ORDER BY row_id) > count(*) OVER () - ceil(0.1::DOUBLE * count(*) OVER ())
                THEN 'test' ELSE 'train' END AS split FROM prefs)""",
                "row_id, split", [("system", _SYS), ("user", "question"), ("assistant", "chosen")],
            ),
            "prefs",
        ),
        "build_pair_set": _with(
            f"""SELECT row_id, c.ids AS input_ids_chosen, c.mask AS attention_mask_chosen, r.ids AS input_ids_rejected,
            r.mask AS attention_mask_rejected, c.was_truncated OR r.was_truncated AS was_truncated, split
            FROM {cut_pairs} JOIN (SELECT row_id, split FROM talks) USING (row_id)""",
            "talks", "sides", "ids_of",
        ),
        "build_prompt_set": _with(
            f"""SELECT row_id, ids AS input_ids, query, was_truncated, split
            FROM ({_encoded('ex_words', 'row_id', 'p', 256)})
            JOIN (SELECT row_id, string_agg(CASE WHEN id IS NULL THEN '<unk>' ELSE tok END, ' ' ORDER BY pos) AS query
                  FROM (SELECT row_id, unnest(w) AS tok, unnest(range(len(w))) AS pos
                        FROM (SELECT row_id, list_slice(p, 1, 256) AS w FROM ex_words))
                  LEFT JOIN ids_of USING (tok) GROUP BY row_id) USING (row_id)
            JOIN (SELECT row_id, {_split(0.1)} AS split FROM ex) USING (row_id)""",
            "ex", "ex_words", "ids_of",
        ),
        "stream_prompts": _with(
            f"""SELECT row_id, {_opened('question')} || '<think>' || repeat(chr(10), 2) || '</think>' || repeat(chr(10), 2) AS prompt,
            answer AS response, round({_SPACING.format('(' + _talk('question', 'answer') + ')')}, 4) AS score
            FROM (SELECT conv_id * 4294967296 + turn AS row_id, text AS question FROM conversations WHERE role = 'user')
            LEFT JOIN (SELECT row_id, answer FROM ex) USING (row_id)""",
            "ex",
        ),
        "stream_generated": f"""
            SELECT row_id, prompt, response, round({_SPACING.format('(' + _talk('question', 'response') + ')')}, 4) AS score
            FROM (SELECT *, {_str("list_slice(list_reverse(string_split(prompt, ' ')), 1, 512)")} AS response
                  FROM (SELECT conv_id * 4294967296 + turn AS row_id, text AS question,
                               {_opened('text')} || '<think>' || repeat(chr(10), 2) || '</think>' || repeat(chr(10), 2) AS prompt
                        FROM conversations WHERE role = 'user'))""",
        "session_turns": _SESSIONS,
        "stream_sessions": _SESSIONS,
        "stream_joined_answers": _with(
            f"""SELECT row_id, {_opened('question')} || {_NO_THINK} AS prompt, response,
            round({_SPACING.format('(' + _talk('question', 'response') + ')')}, 4) AS score
            FROM (SELECT conv_id * 4294967296 + turn AS row_id, text AS question FROM conversations WHERE role = 'user')
            LEFT JOIN (SELECT row_id, answer AS response FROM ex WHERE ('0x' || substr(md5('slow|' || row_id), 1, 8))::BIGINT % 60 <= 45) USING (row_id)""",
            "ex",
        ),
        "stream_step_rewards": _with(f"SELECT {_STEP} FROM steps WHERE run_id = 'run'", "steps"),
        "stream_step_rewards_bounded": _with(
            """SELECT run_id, step, count(*) = 8 AS complete, count(*) AS n, round(avg(reward), 4) AS mean_reward
            FROM rolls WHERE run_id = 'run' AND NOT (step % 7 = 0 AND slot = 3) GROUP BY run_id, step""",
            "rolls",
        ),
    }
