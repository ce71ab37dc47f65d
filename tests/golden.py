"""The hand-made mini warehouse: input rows as JSON documents."""

import json

CATALOGUE = [
    # artist_id, lat, lon, location, artist_name, song_id, title, duration, year
    ("AR1", 59.9, 10.7, "Oslo", "Band One", "SO1", "Alpha", 200.50, 2001),
    ("AR1", None, None, "Oslo", "Band One", "SO2", "Beta", 180.25, 0),
    ("AR1", 59.9, 10.7, "Oslo", "Band One feat. Guest", "SO3", "Gamma", 210.00, 2003),
    ("AR2", None, None, "", "Solo", "SO4", "Delta", 99.99, 0),
    ("AR2", None, None, "", "Solo", "SO4", "Delta", 99.99, 0),
    ("AR3", 1, 1, None, "Band One", "SO5", "Alpha", 200.50, 2010),
    ("AR4", 5, 5, "X", None, "SO6", "Eps", 50.00, 1999),
    ("AR4", None, None, None, None, "SO7", "Eta", 51.00, 1999),
    (None, None, None, None, "Ghost", None, "Iota", 10.00, 2000),
    ("AR2", None, None, "", "Solo", "SO9", "Theta", 246.90, 2015),
]

EVENTS = [
    # ts, user, level, page, artist, song, length, session
    (1000000000123, "1", "free", "NextSong", "Band One", "Alpha", 200.50, 1),
    (1000000000999, "1", "free", "NextSong", "Band One feat. Guest", "Gamma", 210.00, 1),
    (1000000005000, "1", "paid", "Home", None, None, None, 1),
    (1000000010000, "2", "free", "NextSong", "Solo", "Delta", 99.99, 2),
    (1000000010000, "2", "paid", "NextSong", "Band One", "Beta", 180.25, 2),
    (1000000020000, "", "free", "Home", None, None, None, 3),
    (1000000030000, "3", "free", "NextSong", "Nobody", "Zeta", 1.00, 4),
    (1000000040500, "3", "free", "NextSong", "Solo", "Theta", 246.10, 4),
]


def catalogue_documents():
    names = (
        "artist_id artist_latitude artist_longitude artist_location artist_name "
        "song_id title duration year"
    ).split()
    return [{"num_songs": 1, **dict(zip(names, row))} for row in CATALOGUE]


def event_documents():
    documents = []
    for ts, user, level, page, artist, song, length, session in EVENTS:
        documents.append(
            {
                "artist": artist,
                "auth": "Logged In",
                "firstName": f"First{user}",
                "gender": "F",
                "iteminSession": 0,
                "lastName": f"Last{user}",
                "length": length,
                "level": level,
                "location": "Here",
                "method": "PUT",
                "page": page,
                "registration": 1540919166796.0,
                "sessionId": session,
                "song": song,
                "status": 200,
                "ts": ts,
                "userAgent": "agent",
                "userId": user,
            }
        )
    return documents


def write_golden(root):
    """Nested folders: one catalogue document per file, events as lines."""
    for i, document in enumerate(catalogue_documents()):
        folder = root / "catalogue" / "ABC"[i % 3] / str(i)
        folder.mkdir(parents=True)
        (folder / f"{i}.json").write_text(json.dumps(document))
    half = len(EVENTS) // 2
    for name, part in (("01", event_documents()[:half]), ("02", event_documents()[half:])):
        folder = root / "log" / "2001" / name
        folder.mkdir(parents=True)
        (folder / "events.json").write_text("\n".join(json.dumps(d) for d in part))
    return str(root / "log"), str(root / "catalogue")
