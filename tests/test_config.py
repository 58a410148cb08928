import pytest

from heddle.functions import vocab
from heddle.operators.dedupe import expected_rate
from heddle.sources.config import load_config, lookup_table


def test_yaml_and_lookup(spark, tmp_path):
    (tmp_path / "map.yaml").write_text('mogi:\n  "Đầy đủ": full\n', encoding="utf-8")
    assert load_config(tmp_path / "map.yaml") == {"mogi": {"Đầy đủ": "full"}}
    with pytest.raises(FileNotFoundError):
        load_config(tmp_path / "none.yaml")
    assert lookup_table(spark, vocab.FURNISHING).count() == sum(map(len, vocab.FURNISHING.values()))


def test_duplicate_rates():
    assert [expected_rate(r) for r in (0.01, 0.05, 0.2, 0.3, 0.5)] == ["suspicious", "unusual", "expected", "unusual", "suspicious"]
