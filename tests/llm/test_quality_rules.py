from __future__ import annotations

import re
from collections import Counter

from tests.llm.texts import awkward, clashing, documents, prose
from tripline.llm.quality_rules import Rules, quality

BLANK = "\x20\x09-\x0D"


def words(text: str) -> list[str]:
    return re.findall(f"[^{BLANK}]+", text)


def line_fails(line: str, rules: Rules = Rules()) -> bool:
    own = words(line)
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    separators = sum(bool(re.fullmatch(r"[|>]+|[»·•]", w)) for w in own)
    return (
        not any(re.search(r"""[.!?…。！？]["')\]”’»]*$""", w) for w in own)
        or 100 * len(re.findall(r"[#*$%&|<>!]", line)) > rules.marks * len(own)
        or (separators >= 2 and 100 * separators >= rules.separators * len(own))
        or any(phrase in lowered for phrase in rules.phrases)
    )


def brute_force(doc_id, text) -> tuple:
    own = words(text or "")
    counts = Counter(tuple(own[k : k + 3]) for k in range(len(own) - 2))
    repeat = {k + j for k in range(len(own) - 2) if counts[tuple(own[k : k + 3])] > 1 for j in range(3)}
    seen, dup, lost, failed, parts = set(), 0, 0, 0, []
    lines = (text or "").split("\n")
    for k, line in enumerate(lines):
        whole = line + "\n" * (k + 1 < len(lines))
        if words(line):
            dup += line in seen
            seen.add(line)
            if line_fails(line):
                lost += sum(map(len, words(line)))
                failed += 1
                continue
        parts.append(whole)
    chars = sum(map(len, own))
    base = len(own) < 50 or 100 * len(repeat) > 50 * len(own)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return (doc_id, len(own), chars, symbols, dup, len(repeat), base, lost, failed, not base and 100 * lost <= 50 * chars, "".join(parts))


def check(docs) -> None:
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in quality(docs).collect()), key=repr)
    assert found == sorted((brute_force(*row) for row in rows), key=repr)


LINES = [
    "Home | About | Contact\nThis is a text. It has sentences.\n\n\nThis is a text. It has sentences.\nno end here",
    "All Rights\nReserved. all rights reserved. Next.\nclick\nhere.",
    "end with click",
    "here we go.\nfine.",
    'He said "so."\n(he did!)\n»oui.«\n«si.»\nwhy?!”’)\n...\n"\')]\n',
    "a » b » c\n· x · y ·.\n| | |\n>> > >>\nA|B. C>D.",
    "SHOUT!! AT!! ALL!!\nof%%% these*** words.&&&",
    "\n\n",
    "\nx.\n",
    "漢字。\n漢字！\n漢字？\nかな…\nかな",
    "\r\nwin dows.\r\nwin dows.\r\nwin dows.\n",
    " lead.\nlead.\n lead.",
]


def test_awkward_rows(spark):
    check(clashing(documents(spark, awkward() + LINES)))


def test_empty_tables(spark):
    check(documents(spark, []))
    check(documents(spark, [None, ""]))


def test_documents(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_clean_prose_stays(spark):
    text = "\n".join(" ".join(prose(k, 12, 3000)) + "." for k in range(20))
    (row,) = quality(documents(spark, [text])).collect()
    assert row.kept and row.cleaned == text and row.lost_chars == 0


def test_sentences_of_other_scripts(spark):
    """Lines that end as their script ends sentences pass, and Thai and Lao lines, which have no such marks."""
    sentences = {
        "hi": ["क", "ख", "।"], "bn": ["ক", "খ", "।"], "ur": ["ا", "ب", "۔"], "ar": ["ا", "ب", "؟"], "am": ["ሀ", "ለ", "።"],
        "my": ["က", "ခ", "။"], "km": ["ក", "ខ", "។"], "hy": ["ա", "բ", "։"], "th": ["ก", "ข", ""], "lo": ["ກ", "ຂ", ""],
    }
    texts = ["\n".join(" ".join(f"{a * (k + 1)}{b * (n + 1)}" for k in range(9)) + end for n in range(8)) for a, b, end in sentences.values()]
    texts += [text.replace(end, "") for text, (_, _, end) in zip(texts, sentences.values()) if end]
    out = sorted(quality(documents(spark, texts)).collect())
    assert not any(r.base_failed for r in out)
    assert [r.n_failed_lines for r in out] == [0] * 10 + [8] * 8
    assert [r.kept for r in out] == [True] * 10 + [False] * 8
    mixed = quality(documents(spark, ["plain words without an end ก", "กขค plain"])).collect()
    assert [r.n_failed_lines for r in sorted(mixed)] == [1, 1]


def test_sql_states_the_same_rule_in_every_script(spark):
    """Sentence ends beyond Latin script, closing marks behind them, and the scripts that are written without any."""
    import duckdb

    from tripline.llm import queries

    words = [f"слово{k}" for k in range(60)]
    texts = [" ".join(words) + end for end in ["", *".!?…。！？．｡।॥۔؟։።፧፨။។៕།༎᠃᠉", "\u037e", ".»", "؟)”", "। x", "।x", "،", "؛"]]
    thai, lao = [f"ภาษาไทย{k}" for k in range(60)], [f"ພາສາລາວ{k}" for k in range(60)]
    texts += [" ".join(thai), " ".join(lao), " ".join(thai[:5] + words[:55]), " ".join(x + y for x, y in zip(thai, words))]
    texts += [" ".join(thai) + "\n" + " ".join(words), " ".join(thai) + " #" * 50, *(x for x in awkward() if isinstance(x, str))]
    docs = documents(spark, texts)
    query = quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    connection = duckdb.connect()
    connection.register("documents", docs.select("doc_id", "text").toArrow())
    wanted = connection.execute(queries.oracle_sql()["op7_quality_rules"]).fetchall()
    assert sorted(map(tuple, query.collect())) == sorted(wanted)
    assert 10 < sum(row[-1] for row in wanted) < len(wanted) - 5
