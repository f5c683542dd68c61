import json
import pathlib

import pytest
from conftest import rows

from lakeloom import schemas
from lakeloom.operators.quality import QualityError
from lakeloom.plans import warehouse
from lakeloom.sinks.publish import published
from lakeloom.sources.tables import inline_rows

SONGS = [
    {"num_songs": 1, "artist_id": "AR1", "artist_name": "Muse", "artist_location": "Devon", "artist_latitude": 50.7, "artist_longitude": -3.5,
     "song_id": "SO1", "title": "Uprising", "duration": 304.84, "year": 2009},
    {"num_songs": 1, "artist_id": "AR1", "artist_name": "Muse", "artist_location": "", "artist_latitude": None, "artist_longitude": None,
     "song_id": "SO2", "title": "Starlight", "duration": 240.2, "year": 2006},
    {"num_songs": 1, "artist_id": "AR2", "artist_name": "Blur", "artist_location": "London", "artist_latitude": 51.5, "artist_longitude": -0.1,
     "song_id": "SO3", "title": "Song 2", "duration": 121.9, "year": 0},
    {"num_songs": 1, "artist_id": "AR2", "artist_name": "Blur", "artist_location": "London", "artist_latitude": 51.5, "artist_longitude": -0.1,
     "song_id": "SO4", "title": "Song 2", "duration": 122.3, "year": 1997},
]


def log(user, item, ts, page="NextSong", level="free", artist=None, song=None, length=None, session=10):
    return {
        "artist": artist, "auth": "Logged In", "firstName": f"F{user}", "gender": "F", "itemInSession": item, "lastName": "L",
        "length": length, "level": level, "location": "San Jose, CA", "method": "PUT", "page": page, "registration": 1.5e12,
        "sessionId": session, "song": song, "status": 200, "ts": ts, "userAgent": '"Mozilla"', "userId": user,
    }


LOGS = [
    log("5", 0, 1543104000000, artist="Muse", song="Uprising", length=304.84),
    log("5", 0, 1543104000000, artist="Muse", song="Uprising", length=304.84),
    log("5", 1, 1543104000000, artist="Muse", song="Uprising", length=304.84, level="paid"),
    log("6", 0, 1543104000000, artist="Blur", song="Song 2", length=122.1, session=11),
    log("6", 1, 1543190400796, artist="Nobody", song="None", length=1.0, session=11),
    log("", 0, 1543104000000, page="Home", session=12),
    log("7", 0, 1543104000001, page="Login", session=13),
]


@pytest.fixture(scope="module")
def inputs(spark):
    def frame(data, schema):
        return inline_rows(spark, [tuple(d[f] for f in schema.fieldNames()) for d in data], schema)

    return frame(LOGS, schemas.LOG), frame(SONGS, schemas.SONG)


def test_dimensions(inputs):
    star = warehouse.build_star(*inputs)
    assert rows(star["users"], "user_id", "level") == [(5, "paid"), (6, "free")]
    assert rows(star["artists"], "artist_id", "name") == [("AR1", "Muse"), ("AR2", "Blur")]
    assert star["songs"].count() == 4
    assert sorted(r.weekday for r in star["time"].collect()) == [0, 1]
    for name, schema in schemas.STAR.items():
        assert [(f.name, f.dataType) for f in star[name].schema.fields] == [(f.name, f.dataType) for f in schema.fields]


def test_user_policies(inputs):
    events = warehouse.events_from_logs(inputs[0])
    assert rows(warehouse.users(events, "distinct"), "user_id", "level") == [(5, "free"), (5, "paid"), (6, "free")]
    assert rows(warehouse.users(events, "first_sorted"), "user_id", "level") == [(5, "free"), (6, "free")]


@pytest.mark.parametrize(
    ("rule", "matched"),
    [
        ("title_artist", ["SO1", "SO1", "SO3"]),
        ("title_artist_duration", ["SO1", "SO1"]),
        ("title_artist_seconds", ["SO1", "SO1", "SO3"]),
    ],
)
def test_match_rules(inputs, rule, matched):
    kept = warehouse.build_star(*inputs, rule=rule)["songplays"]
    assert kept.count() == 4 and kept.select("songplay_id").distinct().count() == 4
    assert sorted(r.song_id for r in kept.where("song_id is not null").collect()) == matched
    only = warehouse.build_star(*inputs, rule=rule, keep_unmatched=False)["songplays"]
    assert sorted(r.song_id for r in only.collect()) == matched


def test_all_matches(inputs):
    plays = warehouse.build_star(*inputs, rule="title_artist", first_match_only=False)["songplays"]
    assert sorted(r.song_id for r in plays.where("user_id = 6 and song_id is not null").collect()) == ["SO3", "SO4"]
    with pytest.raises(ValueError):
        warehouse.build_star(*inputs, rule="other")


def test_run(spark, tmp_path):
    for n, song in enumerate(SONGS):
        folder = tmp_path / "songs" / "A" / str(n)
        folder.mkdir(parents=True)
        (folder / "s.json").write_text(json.dumps(song))
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "events.json").write_text("\n".join(json.dumps(x) for x in LOGS))
    paths = [str(tmp_path / n) for n in ("songs", "logs", "out")]
    for folders in (("year",), ("year", "artist_id")):
        stored, report = warehouse.run(spark, *paths, song_folders=folders, rule="title_artist")
        assert rows(report) == [
            ("artists", 2), ("songplays", 4), ("songs", 4), ("staging_logs", 7), ("staging_songs", 4), ("time", 2), ("users", 2),
        ]
        assert rows(stored["songs"], "song_id", "year", "artist_id")[0] == ("SO1", 2009, "AR1")
        version = published(spark, paths[2]).path
        assert pathlib.Path(version, "songplays", "year=2018", "month=11").exists()
        star = warehouse.published_star(spark, paths[2])
        assert {n: df.count() for n, df in star.items()} == {"artists": 2, "songplays": 4, "songs": 4, "time": 2, "users": 2}


def test_a_failed_check_leaves_the_old_star(spark, tmp_path):
    for folder, data in (("songs", SONGS), ("logs", LOGS)):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "s.json").write_text("\n".join(json.dumps(x) for x in data))
    paths = [str(tmp_path / n) for n in ("songs", "logs", "out")]
    warehouse.run(spark, *paths, rule="title_artist")
    before = published(spark, paths[2])
    old = warehouse.published_star(spark, paths[2])
    (tmp_path / "logs" / "s.json").write_text(json.dumps(LOGS[-1]))
    with pytest.raises(QualityError, match="songplays has_rows"):
        warehouse.run(spark, *paths)
    assert published(spark, paths[2]) == before
    assert warehouse.published_star(spark, paths[2])["songplays"].count() == 4
    # Frames made before still read their version; nothing of the failed one is left.
    assert old["songplays"].count() == 4
    assert [p.name for p in (tmp_path / "out" / "versions").iterdir()] == [before.version]


def test_run_reports_missing_rows(spark, tmp_path):
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "s.json").write_text(json.dumps(SONGS[0]))
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "e.json").write_text(json.dumps(LOGS[-1]))
    with pytest.raises(QualityError, match="songplays has_rows"):
        warehouse.run(spark, *[str(tmp_path / n) for n in ("songs", "logs", "out")])
