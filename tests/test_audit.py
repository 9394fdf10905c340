"""Verdicts from listings: which archives are opened and which files hashed, and what is found."""

from custodia.operators import audit
from custodia.sources import files

CONTRACT = audit.Contract(companions=("aa.txt",))
IN_FOLDER = ("README.html", "file_list.csv", "manifest.csv", "aa.txt", "related_identifiers.csv")


def folders(spark, staged, raw):
    a = spark.createDataFrame([(s, n, f"/x/{s}/{n}", 1) for s, ns in staged.items() for n in ns], "site string, name string, path string, bytes long")
    return spark.createDataFrame([(s, n, 1) for s, ns in raw.items() for n in ns], "site string, name string, bytes long"), a


def opener(spark, entries, seen):
    def read(paths):
        rows = paths.collect()
        seen.extend(r.path for r in rows)
        found = [(r.site, r.path.rsplit("/", 1)[1], n, None) for r in rows for n in entries.get(r.path.rsplit("/", 1)[1], [])]
        found += [(r.site, r.path.rsplit("/", 1)[1], None, "unreadable") for r in rows if r.path.rsplit("/", 1)[1] not in entries]
        return spark.createDataFrame(found, "site string, archive string, name string, error string")

    return read


def test_only_open_sites_are_read(spark):
    item = "20240102_030405.wav"
    raw = {s: [item, "CONFIG.TXT"] for s in ("done", "none", "mixed", "day", "single", "stray", "broken", "leak", "bare")} | {"odd": ["x.wav", item]} | {"noconf": [item]}
    day = lambda s: f"{s}_2024_01_02.zip"
    staged = {s: [*IN_FOLDER, day(s)] for s in ("day", "broken", "leak", "odd", "noconf", "bare")}
    staged |= {"done": [".prep_complete"], "mixed": ["mixed.zip", day("mixed")], "single": [*IN_FOLDER, "single.zip"], "stray": [*IN_FOLDER, day("stray"), "stray_2030_01_01.zip"]}
    staged["bare"].remove("related_identifiers.csv")
    entries = {day("day"): [item, "config.txt"], "single.zip": [item, "CONFIG.TXT", "file_list.csv", "aa.txt", "related_identifiers.csv"], day("stray"): [item, "CONFIG.TXT"], day("leak"): [item, "CONFIG.TXT", "20240103_000000.wav"], day("noconf"): [item], day("bare"): [item, "CONFIG.TXT"]}
    seen: list[str] = []
    a, b = folders(spark, staged, raw)
    got = {r.site: r.verdict for r in audit.prep_verdicts(a, b, opener(spark, entries, seen), CONTRACT).collect()}
    assert got == {"done": "Yes", "none": "No", "mixed": "No", "day": "Yes", "single": "Yes", "stray": "No", "broken": "Ambiguous", "leak": "No", "bare": "Ambiguous", "odd": "Ambiguous", "noconf": "Ambiguous"}
    # no archive of a site that listings decide, and none of a stray day
    assert sorted(seen) == sorted(f"/x/{s}/{z}" for s, z in [("single", "single.zip"), *((s, day(s)) for s in ("day", "stray", "broken", "leak", "noconf", "bare"))])
    seen.clear()
    got = {r.site: r.verdict for r in audit.prep_verdicts(a, b, opener(spark, entries, seen), audit.Contract(companions=None)).collect()}
    assert seen == [] and got["day"] == got["single"] == "Ambiguous" and got["done"] == "Yes"


def test_only_sound_sites_are_hashed(spark, tmp_path):
    item = "20240102_030405.wav"
    staged = {s: [".prep_complete", "aa.txt", f"{s}_2024_01_02.zip"] for s in ("good", "wrong", "short", "late")}
    staged["late"].remove(".prep_complete")
    rows = []
    for s, names in staged.items():
        (tmp_path / s).mkdir()
        for n in names:
            (tmp_path / s / n).write_text(s)
            rows.append((s, n, str(tmp_path / s / n), 1))
    df = spark.createDataFrame(rows, "site string, name string, path string, bytes long")
    manifest = spark.createDataFrame([(s, item, 5, "") for s in staged], "site string, name string, bytes long, kb_text string")
    entries = spark.createDataFrame([(s, f"{s}_2024_01_02.zip", item, 4 if s == "short" else 5, None) for s in staged], "site string, archive string, name string, bytes long, error string")
    digests = spark.sql("SELECT site, 'aa.txt' AS name, sha2(CASE WHEN site = 'wrong' THEN 'x' ELSE site END, 512) AS digest FROM VALUES ('good'), ('wrong'), ('short'), ('late') AS t(site)")
    hashed: list[str] = []

    def hash_files(paths):
        hashed.extend(r.path for r in paths.collect())
        return files.hash_files(paths)

    got = {r.site: (r.problems, r.n_hashed) for r in audit.gate_verdicts(df, manifest, entries, digests, hash_files, CONTRACT).collect()}
    assert got == {"good": ("", 1), "wrong": ("digests differ", 1), "short": ("manifest and archives differ", 0), "late": ("no sentinel", 0)}
    assert sorted(hashed) == sorted(str(tmp_path / s / "aa.txt") for s in ("good", "wrong"))


def test_sources_against_archives_of_days(spark):
    raw = spark.createDataFrame(
        [(s, n, b, None) for s in ("ok", "stale", "lost", "differs", "bare", "bad") for n, b in (("20240102_000000.wav", 0), ("20240103_000000.wav", 7), ("CONFIG.TXT", 3), ("._20240103_000000.wav", 1))] + [("void", "CONFIG.TXT", 3, None), ("odd", "x.wav", 1, None)],
        "site string, name string, bytes long, discrepancy string",
    )
    zips = [(s, f"{s}_2024_01_0{d}.zip", f"2024_01_0{d}") for s in ("ok", "stale", "lost", "differs", "bare", "bad") for d in (2, 3) if (s, d) != ("lost", 3)] + [("stale", "stale_2030_01_01.zip", "2030_01_01")]
    entries = []
    for s, z, d in zips:
        if (s, d) == ("bad", "2024_01_03"):
            entries.append((s, z, None, None, "unreadable"))
            continue
        size = {"2024_01_02": 0, "2024_01_03": 7}.get(d, 1)
        entries.append((s, z, f"{d.replace('_', '')}_000000.wav", size + (s == "differs"), None))
        if s != "bare":
            entries.append((s, z, "config.TXT", 3, None))
    got = audit.source_rows(raw, spark.createDataFrame(zips, "site string, archive string, day string"), spark.createDataFrame(entries, "site string, archive string, name string, bytes long, error string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.site, set()).add(r.code)
    zero = {"zero-byte items"}
    assert by == {
        "ok": zero, "stale": zero | {"stale day archive"}, "lost": zero | {"day archive missing"}, "differs": zero | {"archive differs from source"}, "bare": zero | {"configuration missing"},
        "bad": zero | {"archive differs from source", "configuration missing"}, "void": {"no items"}, "odd": {"cross-check failed"},
    }
