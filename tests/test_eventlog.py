from conftest import SF_SMALL
from pyspark.sql import functions as F

from mound.sources import fixtures as FX
from mound.sources import eventlog as EV

GAME_1 = [
    "id,DET202304060", "version,2", "info,visteam,BOS", "info,hometeam,DET", "info,date,2023/04/06",
    "start,verda001,\"Alex Verdugo\",0,1,9", "play,1,0,verda001,22,.CBBFX,43/G4+",
    "com,\"challenged (play at 1st), call overturned\"", "sub,turnj001,\"Justin Turner\",0,3,10",
    "play,1,1,meada001,00,,NP", "radj,marsb002,2", "data,er,salec001,3",
]
GAME_2 = [
    "id,DET202304070", "version,2", "info,visteam,BOS", "info,hometeam,DET", "info,date,2023/04/07",
    "play,1,0,verda001,10,BX,S8/G", "badj,ramij003,R", "data,er,salec001,1",
]


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_bytes(("\r\n".join(lines) + "\r\n").encode())
    return p


def test_event_file_two_games_crlf_quoted_commas(spark, tmp_path):
    _write(tmp_path, "2023DET.EVA", GAME_1 + GAME_2)
    blocks = EV.read_game_blocks(spark, str(tmp_path))
    games = {r.game_id: r for r in EV.event_games(blocks).collect()}
    assert set(games) == {"DET202304060", "DET202304070"}
    g = games["DET202304060"]
    assert (g.visteam, g.hometeam, g.date, g.season, g.home_code, g.version) == ("BOS", "DET", "2023/04/06", 2023, "DET", "2")
    lines = EV.event_lines(blocks)
    plays = EV.event_plays(lines).orderBy("game_id", "seq").collect()
    assert [(p.inning, p.side, p.batter_id, p["count"], p.pitch_sequence, p.play) for p in plays] == [
        (1, 0, "verda001", "22", ".CBBFX", "43/G4+"), (1, 1, "meada001", "00", "", "NP"),
        (1, 0, "verda001", "10", "BX", "S8/G")]
    com = EV.event_comments(lines).collect()
    assert [c.text for c in com] == ["challenged (play at 1st), call overturned"]
    lu = EV.event_lineups(lines).orderBy("seq").collect()
    assert [(r.record, r.player_name, r.field_position) for r in lu] == [("start", "Alex Verdugo", 9), ("sub", "Justin Turner", 10)]
    er = {(r.season, r.pitcher_id): (r.games, r.earned_runs) for r in EV.earned_runs_by_pitcher(EV.event_earned_runs(lines)).collect()}
    assert er == {(2023, "salec001"): (2, 4)}
    adj = sorted((r.record, r.player_id, r.value) for r in EV.event_adjustments(lines).collect())
    assert adj == [("badj", "ramij003", "R"), ("radj", "marsb002", "2")]


def test_event_lines_keep_every_field(spark, tmp_path):
    _write(tmp_path, "2023DET.EVA", ["id,DET202304060", "version," + "2" * 150, "info,roof,open", "info,roof,shut",
                                     'com,a,,"b ""c"", d","",e,f,g,h,i,j', "play,1,0,x001,22,,NP", "com,$last", "play,1,1,y001,00,X,K"])
    blocks = EV.read_game_blocks(spark, str(tmp_path))
    com = EV.event_lines(blocks, ("com",)).orderBy("seq").collect()
    assert [c.fields for c in com] == [["a", None, 'b "c", d', "", "e", "f", "g", "h", "i", "j"], ["$last"]]
    assert [(c.seq, c.nth) for c in com] == [(4, 1), (6, 2)]
    assert [(p.seq, p.play_index, p.pitch_sequence) for p in EV.indexed_plays(blocks).orderBy("seq").collect()] == [
        (5, 1, ""), (7, 2, "X")]
    game = EV.event_games(blocks).collect()[0]
    assert game.version == "2" * 150
    assert [(r.key, r.value) for r in game.info_records] == [("roof", "open"), ("roof", "shut")]
    assert "Exchange" not in EV.indexed_plays(blocks)._jdf.queryExecution().executedPlan().toString()


def test_rosters_skip_fragment_and_dedup(spark, tmp_path):
    _write(tmp_path, "NYN2023.ROS", ["alonp001,Alonso,Pete,R,R,NYN,1B", "almoa001,Almonte,Abraham,B,R,NYN,PH"])
    _write(tmp_path, "ARI2023.ROS", ["alonp001,Alonso,Pete,R,R,ARI,1B"])
    _write(tmp_path, "ari", ["castm002,Castro,Miguel,R,R,ARI,P"])
    r = EV.read_rosters(spark, str(tmp_path))
    rows = r.collect()
    assert len(rows) == 3 and {x.season for x in rows} == {2023}
    assert {x.file_team for x in rows} == {"NYN", "ARI"}
    players = {x.player_id: x.team for x in EV.roster_players(r).collect()}
    assert players == {"alonp001": "NYN", "almoa001": "NYN"}


def test_team_list(spark, tmp_path):
    _write(tmp_path, "TEAM2023", ["ANA,A,Anaheim,Angels", "ARI,N,Arizona,Diamondbacks"])
    rows = EV.read_team_list(spark, str(tmp_path / "TEAM2023")).collect()
    assert [(r.team_code, r.league, r.city, r.nickname) for r in rows] == [
        ("ANA", "A", "Anaheim", "Angels"), ("ARI", "N", "Arizona", "Diamondbacks")]


def test_malformed_lines(spark, tmp_path):
    """A bad line fails no job: it is set apart with its file, game, place and reason."""
    (tmp_path / "2024AAA.EVA").write_bytes(b"\r\n".join([
        b"id,AAA202404010", b"version,2", b"info,visteam,BBB", b"start,p1,\"A, B\",0,1,6", b"start,p2,short", b"play,1,0,c1,00,,K", b"play,one,0,c1,00,,K",
        b"play,2,,c1,00,,K", b"zzz", b"com,\"fine, too\"", b"data,er,p1,x", b"data,er,p1,2", b"id,AAA2024xx010", b"play,1,1,c2,12,CBX,HR/F7", b"play,1,1", b""]))
    blocks = EV.read_game_blocks(spark, str(tmp_path))
    lines, rejects = EV.split_lines(blocks)
    got = {(r.game_id, r.seq): (r.line, r.reason) for r in rejects.collect()}
    assert got == {
        ("AAA202404010", 4): ("start,p2,short", "too few fields"), ("AAA202404010", 6): ("play,one,0,c1,00,,K", "field 1 is not a whole number"),
        ("AAA202404010", 7): ("play,2,,c1,00,,K", "field 2 is not a whole number"), ("AAA202404010", 8): ("zzz", "unknown record"),
        ("AAA202404010", 10): ("data,er,p1,x", "field 3 is not a whole number"), ("AAA2024xx010", 0): ("id,AAA2024xx010", "game id without a date"),
        ("AAA2024xx010", 2): ("play,1,1", "too few fields")}
    assert {r.file_name for r in rejects.collect()} == {"2024AAA.EVA"}
    assert lines.count() == 7 and sorted(r.inning for r in EV.event_plays(lines).collect()) == [1, 1]
    # the unchecked tables have nulls in place of what does not parse
    every = EV.event_lines(blocks)
    assert sorted((r.inning is None, r.side) for r in EV.event_plays(every).collect() if r.batter_id == "c1" and r.side == 0) == [(False, 0), (True, 0)]
    assert [r.earned_runs for r in EV.event_earned_runs(every).orderBy("seq").collect()] == [None, 2]
    assert {r.game_id: r.game_day is None for r in EV.event_games(blocks).collect()} == {"AAA202404010": False, "AAA2024xx010": True}


def test_malformed_roster_lines(spark, tmp_path):
    (tmp_path / "NYN2024.ROS").write_text("a1,Last,First,L,R,NYN,P\nshort,line\nb1,\"La, st\",First,R,R,NYN,C\n,No,Id,R,R,NYN,C\nx,y,z,R,R,NYN,C,more\n")
    (tmp_path / "odd.ROS").write_text("c1,Last,First,L,R,NYN,P\n")
    good, rejects = EV.split_rosters(spark, str(tmp_path))
    assert sorted((r.player_id, r.last_name, r.season) for r in good.collect()) == [("a1", "Last", 2024), ("b1", "La, st", 2024)]
    assert sorted((r.file_name, r.reason) for r in rejects.collect()) == [
        ("NYN2024.ROS", "no player id"), ("NYN2024.ROS", "not seven fields"), ("NYN2024.ROS", "not seven fields"), ("odd.ROS", "no season in the file's name")]


def test_plain_lines_are_cut_as_quoted_ones(spark, tmp_path):
    _write(tmp_path, "2023DET.EVA", ["id,DET202304060", "com,a,,b,", "com", ",com,x", "com,", 'com,"a, b",,'])
    got = [(r.record, r.fields) for r in EV.event_lines(EV.read_game_blocks(spark, str(tmp_path))).orderBy("seq").collect()]
    assert got == [("com", ["a", None, "b", None]), ("com", []), ("", ["x"]), ("com", [None]), ("com", ["a, b", None, None])]


def test_event_files_are_made_where_a_game_s_rows_meet(spark, tmp_path):
    """Rows are shuffled, not lines of text; the files are compressed."""
    blocks = FX.event_file_games(spark, SF_SMALL)
    assert "Generate" not in blocks._jdf.queryExecution().executedPlan().toString()
    FX.write_event_files(spark, SF_SMALL, str(tmp_path / "ev"))
    files = [f.name for f in (tmp_path / "ev").iterdir() if f.name.startswith("part-")]
    assert files and all(f.endswith(".gz") for f in files)
    assert EV.event_games(EV.read_game_blocks(spark, str(tmp_path / "ev"))).count() == blocks.count()


def test_lines_are_not_sorted_by_verdict(spark, tmp_path):
    """Lines are stored as they come, not in a folder for each verdict, for which a task would sort them all."""
    _write(tmp_path, "2023DET.EVA", GAME_1 + ["zzz"] + GAME_2)
    lines, rejects = EV.split_lines(EV.read_game_blocks(spark, str(tmp_path)))
    assert not any("rejected=" in f for f in lines.inputFiles() + rejects.inputFiles())
    assert lines.count() == len(GAME_1) + len(GAME_2) - 2 and [r.line for r in rejects.collect()] == ["zzz"]


def test_a_games_rows_are_gathered_behind_their_shuffle(spark, monkeypatch):
    small = FX.event_file_games(spark, SF_SMALL)
    monkeypatch.setattr(FX, "PART_BYTES", 1 << 10)  # as many parts as of a large table
    assert sorted(FX.event_file_games(spark, SF_SMALL).collect()) == sorted(small.collect())
    plan = FX.event_file_games(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    # printed from the result down: both halves of the aggregate lie above the shuffle of the rows
    assert plan.index("partial_collect_list") < plan.index("REPARTITION_BY_NUM")
    assert "partial_collect_list" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_event_file_lines_are_made_row_by_row(spark):
    """A row's lines by generated code, not in a lambda over a game's rows, which has none."""
    plan = FX.event_file_games(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "filter(" not in plan


def test_fields_cut_plainly_are_those_of_the_pattern(spark, tmp_path):
    """Every shape of a line gives the fields that the pattern gives, with ``nth`` and without."""
    odd = ['com,a,,b,', "com", ",com,x", "com,", 'com,"a, b",,', 'com,"a, b"', 'com,"",x', 'com,x"y"z,1', 'com,"a"b,c', 'com,a,"b ""c"" d",e', 'com,"open,1',
           'com,"a","b"', 'com,"a",1,"b, c",,2', '"com",a', 'com,é,"ü, ö",1', 'com,a"', 'com,,"q",', "play,1,0,x,00,,K", "play,1,0,x,00,CBX,K\r", 'start,p,"N, M",0,1,9']
    _write(tmp_path, "2023DET.EVA", ["id,DET202304060", *odd])
    blocks = EV.read_game_blocks(spark, str(tmp_path))
    lines = EV.event_lines(blocks)
    got = lines.select("seq", "nth", "record", "line", "fields", EV._parse(F.col("line")).alias("pattern")).orderBy("seq").collect()
    assert [(r.seq, r.nth, r.line) for r in got] == [(i, i, line.rstrip("\r")) for i, line in enumerate(odd, 1)]
    quoted = [r for r in got if '"' in r.line or r.line.startswith(",")]
    assert [r.fields for r in quoted] == [r.pattern for r in quoted]
    plain = [r for r in got if r not in quoted]
    assert [r.fields for r in plain] == [[f or None for f in r.line.split(",")[1:]] for r in plain]
    for chosen in (("com",), ("play", "start")):
        numbered = EV.event_lines(blocks, chosen).orderBy("seq")
        assert [r.nth for r in numbered.collect()] == list(range(1, numbered.count() + 1))
        assert EV.event_lines(blocks, chosen, nth=False).orderBy("seq").collect() == numbered.drop("nth").collect()


def test_event_files_of_large_tables_are_made_in_smaller_parts(spark, monkeypatch):
    """Lines take many times the bytes of their rows: a part of 8 MB was spilled where its lines were gathered."""
    monkeypatch.setattr(FX, "PART_BYTES", 1 << 13)
    parts = FX.parts_of(spark, SF_SMALL, "lineitem") + FX.parts_of(spark, SF_SMALL, "orders")
    assert parts > 8
    plan = FX.event_file_games(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert f", {4 * parts}), REPARTITION_BY_NUM" in plan
