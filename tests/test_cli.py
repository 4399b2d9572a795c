import json

from glossa.__main__ import main


def test_cli_load_contracts_export(spark, tmp_dir, capsys):
    export = {"phrases": {"p1": {"text": {"it": "Ciao", "en": "Hello"}, "register": "informale", "themeId": "t"}},
              "vocabulary": {"v1": {"lemma": {"it": "casa"}}}}
    path = f"{tmp_dir}/export.json"
    with open(path, "w", encoding="utf-8") as fh:
        json.dump(export, fh)
    root = f"{tmp_dir}/corpus"
    assert main(["load", path, root, "--import-date", "2026-01-01"]) == 0
    assert main(["contracts", root]) == 0
    assert main(["export", root, f"{tmp_dir}/out"]) == 0
    assert "exported 0 rows" in capsys.readouterr().out  # no confidence yet: nothing is eligible
