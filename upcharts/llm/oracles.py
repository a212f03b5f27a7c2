"""DuckDB statements of operators whose SQL is long, written from the definitions."""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def similar(shingle: int, percent: int, kept: str = "") -> str:
    """Components of documents whose shingle sets reach a similarity, by the plain join on shingles."""
    return rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS words FROM documents
        ),
        s AS (
          SELECT doc_id, CASE WHEN len(words) >= {shingle}
              THEN list_distinct([array_to_string(words[i:i + {shingle - 1}], ' ') FOR i IN range(1, len(words) - {shingle - 2})])
              WHEN len(words) > 0 THEN ['short ' || len(words) || ': ' || array_to_string(words, ' ')] ELSE [] END AS grams
          FROM w
        ),
        g AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM s),
        links AS (
          SELECT a.doc_id AS u, b.doc_id AS v FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id
          GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))
        ),
        reach AS (
          SELECT doc_id AS u, doc_id AS v FROM documents
          UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v
        ),
        c AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
        SELECT s.doc_id, CAST(len(grams) AS BIGINT) AS n_shingles, component_id{kept} FROM s JOIN c USING (doc_id)
    """


#: spelling variants: crc32 by its table, near words by the join on words with one place cut out
SPELLING = r"""
        WITH RECURSIVE crc AS (
          SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR i IN range(256)] AS steps
        ),
        runs AS (
          SELECT doc_id, run, count(*) AS n
          FROM (SELECT doc_id, unnest(regexp_extract_all(LOWERED, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
          GROUP BY ALL
        ),
        bytes AS (
          -- every code point of a run has one byte or, from U+00C0 on, two
          SELECT doc_id, run, n, list_concat([4294967295::BIGINT], flatten([
              CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END
              FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')])) AS b
          FROM runs
        ),
        hashed AS (
          SELECT run, n, xor(list_reduce(b, lambda c, x: xor(c // 256, steps[xor(c, x) % 256 + 1])), 4294967295) AS h
          FROM bytes, crc
        ),
        spelt AS (
          SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
          FROM hashed
        ),
        words AS (SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        cuts AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
        near AS (
          SELECT a.word, b.word AS other, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
        ),
        best AS (
          SELECT word, count(*) AS n_near, arg_min(other, (-n, other)) AS form, max(n) AS form_n FROM near GROUP BY word
        ),
        forms AS (
          SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 2 * w.n THEN form END AS form,
            CASE WHEN form_n >= 2 * w.n THEN form_n END AS form_n
          FROM words w LEFT JOIN best USING (word)
        ),
        steps AS (
          SELECT word, word AS root, form AS next FROM forms
          UNION ALL SELECT s.word, s.next, f.form FROM steps s JOIN forms f ON f.word = s.next
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM steps WHERE next IS NULL) USING (word)
""".replace("LOWERED", _LOWERED)


_KEEP = {"start": {"s": "system", "u": "user"}, "system": {"u": "user"}, "user": {"a": "assistant"}, "assistant": {"u": "user"}}
_ADDED = {"start": "user", "system": "user", "user": "assistant", "assistant": "user"}


def _step() -> str:
    """Least cost, letters and turns in front of a row, for each state."""
    out = []
    for q in _ADDED:
        ways = [f"{{'cost': b.{q}.cost + 2, 'audit': 'D' || b.{q}.audit, 'turns': b.{q}.turns}}"]
        for initial, to in _KEEP[q].items():
            kept = f"{{'cost': b.{to}.cost + r.extra, 'audit': 'K' || b.{to}.audit, 'turns': list_prepend(r.role || ':' || r.text, b.{to}.turns)}}"
            ways.append(f"CASE WHEN r.stays AND r.initial = '{initial}' THEN {kept} END")
        to = _ADDED[q]
        named = f"{{'cost': b.{to}.cost + r.extra + 1, 'audit': 'R' || b.{to}.audit, 'turns': list_prepend('{to}:' || r.text, b.{to}.turns)}}"
        ways.append(f"CASE WHEN r.stays THEN {named} END")
        out.append(f"list_sort(list_filter([{', '.join(ways)}], lambda x: x IS NOT NULL))[1] AS {q}")
    return ",\n              ".join(out)


#: conversation repair: crc32 by its table, costs and letters row by row from the end
REPAIR = r"""
        WITH RECURSIVE crc AS (
          SELECT [list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) FOR i IN range(256)] AS steps
        ),
        kinds AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            xor(list_reduce(list_concat([4294967295::BIGINT],
                  [unicode(x)::BIGINT FOR x IN string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
                lambda c, x: xor(c // 256, steps[xor(c, x) % 256 + 1])), 4294967295) % 20 AS kind
          FROM conversations, crc
        ),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM kinds, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) WHERE kind <> 0
        ),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
            rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
          FROM damaged
        ),
        judged AS (
          SELECT *, left(role, 1) AS initial,
            CASE WHEN solid = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate' WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
          FROM placed
        ),
        r AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM judged),
        -- an insert costs more than to delete its neighbour and what that leaves, so the least cost has none
        b AS (
          SELECT conv_id, max(place) + 1 AS place, {'cost': 0, 'audit': '', 'turns': []::VARCHAR[]} AS start,
            {'cost': 1000000, 'audit': '', 'turns': []::VARCHAR[]} AS system, {'cost': 1000000, 'audit': '', 'turns': []::VARCHAR[]} AS user,
            {'cost': 0, 'audit': '', 'turns': []::VARCHAR[]} AS assistant
          FROM r GROUP BY conv_id
          UNION ALL
          SELECT b.conv_id, r.place,
              STEP
          FROM b JOIN r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.place = b.place - 1
        ),
        pairs AS (
          SELECT conv_id, fault, turn, initial, lag(initial) OVER (PARTITION BY conv_id ORDER BY place) AS before FROM judged
        ),
        counts AS (
          SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
            count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
            count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
          FROM pairs GROUP BY conv_id
        )
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
          coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.start.cost, 0)::BIGINT AS cost,
          coalesce(b.start.audit, '') AS audit, sha256(coalesce(array_to_string(b.start.turns, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) ids
        LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM ids.conv_id AND b.place = 1
""".replace("STEP", _step())


#: repeated windows of 35 words: each window as one string, its count, and the words it covers
REPEATS = r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        windows AS (
          SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM w, unnest(range(1, len(words) - 33)) AS t(i)
        ),
        repeated AS (SELECT doc_id, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)),
        gone AS (SELECT DISTINCT doc_id, i + k AS place FROM repeated, unnest(range(35)) AS t(k)),
        placed AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM w),
        kept AS (
          SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
          FROM placed ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
        )
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
          sha256(coalesce(kept.text, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
"""
