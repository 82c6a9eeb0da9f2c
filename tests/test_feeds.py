import json
import os

import pytest

from huddlekit.sources.feeds import (FEED_A_FORMATS, check_formats, conform_feed_a, conform_feed_b,
                                     feed_a_damage, feed_a_document_totals, read_feed_a, read_text_documents,
                                     read_wiki_pages)

def _doc_a(players, **meta):
    return {"status": "Success", "meta": meta, "players": players}


def _land(root, rel, doc, cut=None):
    d = os.path.join(root, rel)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "doc.json"), "w") as f:
        f.write(json.dumps(doc, indent=2)[:cut])


def test_feed_a_conforms_numbers_and_text_alike(spark, tmp_path):
    root = str(tmp_path / "feed")
    numbers = {"player_id": 71, "name": "Num Ber", "adp": 30.25, "high": 22, "low": 41, "times_drafted": 6}
    texts = {"player_id": "72", "name": "Tex T", "adp": " 31.5 ", "high": "23.0", "low": "late", "times_drafted": ""}
    _land(root, "season=2031/scoring_format=2qb/teams=10",
          _doc_a([numbers, texts], total_drafts="50", start_date="2031-07-01", end_date="soon"))
    rows = conform_feed_a(read_feed_a(spark, root), "2031-07-09").collect()
    got = {r.source_player_id: (r.adp, r.adp_earliest_pick, r.adp_latest_pick, r.times_drafted) for r in rows}
    assert got == {"71": (30.25, 22, 41, 6), "72": (31.5, 23, None, None)}
    r = rows[0]
    assert (r.source, r.season, r.scoring_format, r.teams, r.total_drafts) == ("ffc", 2031, "2qb", 10, 50)
    assert str(r.window_start_date) == "2031-07-01" and r.window_end_date is None
    assert r.source_rank is None and r.draft_selected_pct is None     # the other feed's columns


def test_feed_a_totals_and_damage(spark, tmp_path):
    root = str(tmp_path / "feed")
    _land(root, "season=2031/scoring_format=ppr/teams=8", _doc_a([{"player_id": 1}] * 3, total_drafts=4))
    _land(root, "season=2032/scoring_format=ppr/teams=8", _doc_a([], total_drafts=0))
    _land(root, "season=2033/scoring_format=ppr/teams=8", {"status": "Error"})
    _land(root, "season=2034/scoring_format=ppr/teams=8", _doc_a([]), cut=20)
    docs = read_feed_a(spark, root)
    totals = {t.season: (t.n_players, t.total_drafts, t.is_empty) for t in feed_a_document_totals(docs).collect()}
    assert totals == {2031: (3, 4, False), 2032: (0, 0, True), 2033: (0, None, True), 2034: (0, None, True)}
    damaged = {t.season: t.damaged for t in feed_a_damage(docs).collect()}
    assert [s for s, text in sorted(damaged.items()) if text is not None] == [2034]
    assert len(damaged[2034]) == 20                                   # its whole text


def test_feed_b_player_node_shapes(spark, tmp_path):
    root = str(tmp_path / "feed")

    def player(i, avg, first):
        return {"id": i, "rank": "7", "averagePick": avg, "minPick": first, "maxPick": "80",
                "draftsSelectedIn": "3", "draftSelPct": "12"}

    shapes = {2031: [player("p1", "40.5", "33"), player("p2", "n/a", "34")],   # a list
              2032: player("p3", "8", "first"),                                # one object
              2033: [], 2034: None}
    for season, node in shapes.items():
        _land(root, f"season={season}/scoring_format=standard/teams=14", {"adp": {"totalDrafts": "21", "player": node}})
    _land(root, "season=2035/scoring_format=standard/teams=14", {"adp": {}})
    out = conform_feed_b(read_text_documents(spark, root), "2031-07-09")
    got = sorted((r.season, r.source_player_id, r.adp, r.adp_earliest_pick, r.total_drafts) for r in out.collect())
    assert got == [(2031, "p1", 40.5, 33, 21), (2031, "p2", None, 34, 21), (2032, "p3", 8.0, None, 21)]


def test_format_allow_list():
    check_formats(["ppr", "standard"])
    with pytest.raises(ValueError):
        check_formats(["ppr", "superflex"], FEED_A_FORMATS)


def test_wiki_pages(spark, tmp_path):
    d = tmp_path / "wiki"
    d.mkdir()
    (d / "a.json").write_text(json.dumps({"parse": {"title": "T", "wikitext": "{{x}}"}}))
    (d / "b.json").write_text(json.dumps({"error": {"code": "missingtitle", "info": "nope"}}))
    got = sorted((r.title or "", r.wikitext, r.error_code) for r in read_wiki_pages(spark, str(d)).collect())
    assert got == [("", None, "missingtitle"), ("T", "{{x}}", None)]
