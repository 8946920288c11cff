"""The command line over a small folder of day files."""

import json
from pathlib import Path

import pytest

from tickloom import cli
from tickloom.sources.adapter import driver_events

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_export_and_reports(spark, tmp_path, capsys):
    events = driver_events(spark, str(DATA))
    for day in ("2024-01-16", "2024-01-17"):
        events.where(f"trade_date = '{day}'").coalesce(1).write.parquet(str(tmp_path / f"in/day-{day.replace('-', '')}.parquet"))
    config = tmp_path / "c.toml"
    config.write_text(
        f"""
[input]
data_dir = "file://{tmp_path}/in"
filename_pattern = "day-{{date}}.parquet"
[sampling]
bin_size_seconds = 600
[sequence]
window_size = 3
[labeling]
horizons = [1, 2]
[dates]
start_date = "2024-01-15"
end_date = "2024-01-17"
exclude_dates = ["2024-01-15"]
[export]
output_dir = "{tmp_path}/out"
split_dates = ["2024-01-16", "2024-01-20"]
"""
    )
    assert cli.main(["export", "--config", str(config)]) == 0
    found = json.loads((tmp_path / "out/dataset_manifest.json").read_text())
    assert found["complete"] and set(found["splits"]) == {"train", "val"} and (tmp_path / "out/export_config.toml").exists()
    names = {p.name for p in (tmp_path / "out/train").iterdir()}
    assert "SYN_20240116_sequences.npy" in names and len(names) == 6
    meta = json.loads((tmp_path / "out/train/SYN_20240116_metadata.json").read_text())
    assert meta["n_sequences"] == found["splits"]["train"]["n_sequences"] > 0 and len(meta["feature_names"]) == 34
    assert (tmp_path / "out/train" / meta["normalization"]["params_file"]).exists()
    with pytest.raises(FileExistsError):
        cli.main(["export", "--config", str(config)])
    assert cli.main(["profile", "--config", str(config), "--date", "2024-01-16"]) == 0
    assert cli.main(["coverage", "--config", str(config)]) == 0
    assert "2024-01-16" in capsys.readouterr().out


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_bad_rows_of_delimited_files_are_counted(spark, tmp_path):
    events = driver_events(spark, str(DATA)).where("trade_date = '2024-01-16'").orderBy("seq").toPandas()
    (tmp_path / "in").mkdir()
    target = tmp_path / "in/day-20240116.csv"
    events.to_csv(target, index=False)
    lines = target.read_text().splitlines()
    at = lines[0].split(",").index("price_nano")
    bad = lines[3].split(",")
    bad[at] = "not a number"
    target.write_text("\n".join([*lines[:3], ",".join(bad), *lines[4:]]) + "\n")
    config = tmp_path / "c.toml"
    config.write_text(
        f"""
[input]
data_dir = "file://{tmp_path}/in"
filename_pattern = "day-{{date}}.csv"
[sampling]
bin_size_seconds = 600
[sequence]
window_size = 3
[labeling]
horizons = [1, 2]
[dates]
start_date = "2024-01-16"
end_date = "2024-01-16"
[export]
output_dir = "{tmp_path}/out"
split_dates = ["2024-01-16", "2024-01-20"]
"""
    )
    assert cli.main(["export", "--config", str(config)]) == 0
    found = json.loads((tmp_path / "out/train/SYN_20240116_diagnostics.json").read_text())["summary"]
    assert found["decode_errors"] == 1 and found["decode_truncated"] is False


@pytest.mark.skipif(not DATA.exists(), reason="needs the driver's tables")
def test_export_from_feeds(spark, tmp_path):
    from tickloom.sources import feed, stores

    events = driver_events(spark, str(DATA)).where("trade_date between '2024-01-16' and '2024-01-17'")
    for _ in range(2):  # written again, days are replaced
        feed.write_feed(events, f"file://{tmp_path}/in", 50)
    assert sorted(p.name for p in (tmp_path / "in").glob("*.feed")) == ["SYN_20240116.feed", "SYN_20240117.feed"]
    config = tmp_path / "c.toml"
    config.write_text(
        f"""
[input]
data_dir = "file://{tmp_path}/in"
filename_pattern = "SYN_{{date}}.feed"
[sampling]
bin_size_seconds = 600
[sequence]
window_size = 3
[labeling]
horizons = [1, 2]
[dates]
start_date = "2024-01-16"
end_date = "2024-01-17"
[export]
output_dir = "file://{tmp_path}/out"
split_dates = ["2024-01-16", "2024-01-20"]
"""
    )
    assert cli.main(["export", "--config", str(config)]) == 0
    meta = json.loads((tmp_path / "out/train/SYN_20240116_metadata.json").read_text())
    assert meta["provenance"]["source_file"] == "SYN_20240116.feed" and meta["provenance"]["data_file_sha256"] == stores.sha256_of(f"{tmp_path}/in/SYN_20240116.feed")
    found = json.loads((tmp_path / "out/train/SYN_20240116_diagnostics.json").read_text())["summary"]
    assert found["decode_errors"] == 0 and found["total_trade_records"] == meta["n_trade_records"] > 0
