import re

from common import corpus, frame, ws_words

from strata.llm import rules as R


def brute(text):
    text = text or ""
    w, seen, dup = ws_words(text), set(), 0
    for line in text.split("\n"):
        if ws_words(line):
            dup += line in seen
            seen.add(line)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    cover = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 8)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)


def test_measures_match_brute_force(spark):
    rows = corpus() + [(400, "x\ny\nx\nx\n#*$ |<>&%"), (401, "a b c d e f g h a b c d e f g h i")]
    out = R.rule_ledger(frame(spark, rows, n_words=7, fail_bits="clash"), carry=["doc_id", "text", "n_words"]).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(r.text)
        assert bool(r.fail_bits & 1) == (r.n_words < 20)
        assert bool(r.fail_bits & 2) == (100 * r.n_repeat_words > 30 * r.n_words)


def test_policies_and_ablations(spark):
    ledger = R.rule_ledger(frame(spark, corpus())).cache()
    rows = ledger.collect()
    mask = R.mask_of(R.POLICIES["v1"])
    got = {r.rule: r for r in R.ablations(ledger, "v1").collect()}
    kept = sum(r.fail_bits & mask == 0 for r in rows)
    for name in R.POLICIES["v1"]:
        one = R.mask_of([name])
        assert got[name].n_kept == kept and got[name].n_docs == len(rows)
        assert got[name].n_rejected == sum(bool(r.fail_bits & one) for r in rows)
        assert got[name].n_kept_without == sum(r.fail_bits & mask & ~one == 0 for r in rows)
    assert ledger.where(R.passes("v1")).count() == kept


def test_empty_table(spark):
    empty = frame(spark, corpus()[:1]).limit(0)
    assert R.rule_ledger(empty).count() == 0
    assert R.ablations(R.rule_ledger(empty), "base").first().n_kept == 0
