"""Archives decoded from the front, whole and cut off."""

import gzip
import io
import zipfile

import pytest

from ratesmith.sources import containers, ranges

TEXT = "".join(f"line {i} é\r\n" for i in range(3000))


def archive(*members, unseekable=False):
    out = io.BytesIO()

    class Stream(io.RawIOBase):  # a stream can't go back to write sizes, so they follow the data
        def writable(self):
            return True

        def write(self, b):
            return out.write(b)

    with zipfile.ZipFile(Stream() if unseekable else out, "w") as z:
        for name, text, how in members:
            z.writestr(zipfile.ZipInfo(name), text, how)
    return out.getvalue()


def lines(text):
    return [x.removesuffix("\r") for x in text.split("\n")][: -1 if text.endswith("\n") else None]


def read(spark, path, cap=None):
    files = ranges.listed(spark, str(path))
    got = {}
    for r in containers.read_lines(files, cap).orderBy("file", "member", "line").collect():
        got.setdefault((r.file.rsplit("/", 1)[1], r.member), []).append(r.value)
    return got, {(r.file.rsplit("/", 1)[1], r.member): (r.bytes, r.truncated, r.error) for r in containers.states(files, cap).collect()}


@pytest.mark.parametrize("step", [7, 1 << 20])
def test_whole_files(spark, tmp_path, monkeypatch, step):
    monkeypatch.setattr(containers, "STEP", step)
    short = TEXT[:200] + "no end"
    (tmp_path / "a.zip").write_bytes(archive(("one.csv", short, zipfile.ZIP_DEFLATED), ("dir/two.csv", short * 2, zipfile.ZIP_STORED), ("empty", "", zipfile.ZIP_STORED), ("last", "x\n", zipfile.ZIP_DEFLATED)))
    (tmp_path / "s.zip").write_bytes(archive(("one.csv", short, zipfile.ZIP_DEFLATED), ("two.csv", "b\n", zipfile.ZIP_DEFLATED), unseekable=True))
    (tmp_path / "g.gz").write_bytes(gzip.compress(short.encode()) + gzip.compress(b"\nsecond stream\n"))
    (tmp_path / "p.csv").write_bytes(short.encode())
    got, states = read(spark, tmp_path)
    assert got == {
        ("a.zip", "one.csv"): lines(short), ("a.zip", "dir/two.csv"): lines(short * 2), ("a.zip", "last"): ["x"], ("s.zip", "one.csv"): lines(short), ("s.zip", "two.csv"): ["b"],
        ("g.gz", ""): [*lines(short), "second stream"], ("p.csv", ""): lines(short),
    }
    assert not any(cut or why for _, cut, why in states.values()) and states["a.zip", "empty"][0] == 0 and states["p.csv", ""][0] == len(short.encode())


def test_cut_off_and_capped(spark, tmp_path):
    import os

    noise = "\n".join(os.urandom(20).hex() for _ in range(4000))
    packed = archive(("one.csv", noise, zipfile.ZIP_DEFLATED), ("two.csv", noise, zipfile.ZIP_DEFLATED))
    (tmp_path / "z.zip").write_bytes(packed[: len(packed) * 3 // 4])
    (tmp_path / "g.gz").write_bytes(gzip.compress(noise.encode())[:30_000])
    got, states = read(spark, tmp_path)
    assert got["z.zip", "one.csv"] == lines(noise) and not states["z.zip", "one.csv"][1]
    for key in (("z.zip", "two.csv"), ("g.gz", "")):
        n = len(got[key])
        assert states[key][1] and 100 < n < 4000 and got[key][:-1] == lines(noise)[: n - 1] and lines(noise)[n - 1].startswith(got[key][-1])
    got, states = read(spark, tmp_path / "z.zip", cap=1000)
    assert states["z.zip", "one.csv"] == (1000, True, None) and "\n".join(got["z.zip", "two.csv"]) == noise[:1000]


def test_a_member_that_cannot_be_decoded_is_named(spark, tmp_path):
    (tmp_path / "b.zip").write_bytes(archive(("ok", "a\n", zipfile.ZIP_DEFLATED), ("bz", "b\n" * 50, zipfile.ZIP_BZIP2)))
    got, states = read(spark, tmp_path)
    assert got == {("b.zip", "ok"): ["a"]} and [x for _, _, x in states.values() if x]
