"""The command-line front end on tiny inputs (same session)."""

import os

from tessera.__main__ import main
from tessera.session import scratch_path


def test_cli_store_search_perplexity(spark, capsys):
    root = scratch_path(spark, "cli")
    for split, n in (("train", 4), ("eval", 2)):
        for i in range(n):
            os.makedirs(f"{root}/docs/{split}", exist_ok=True)
            with open(f"{root}/docs/{split}/d{i}.txt", "w") as f:
                f.write(f"sea level rise {i}\nforest fire season {i}\n" * 20)
    with open(f"{root}/questions.txt", "w") as f:
        f.write("sea level rise\nforest fire\n")
    main(["build-store", "--data-dir", f"{root}/docs", "--output-dir", f"{root}/store"])
    main(["search", "--store", f"{root}/store", "--questions", f"{root}/questions.txt",
          "--k", "3", "--rerank", "--output", f"{root}/report"])
    assert any(n.endswith(".csv") for n in os.listdir(f"{root}/report"))
    main(["perplexity", "--train-dir", f"{root}/docs/train", "--eval-dir", f"{root}/docs/eval"])
    assert "perplexity" in capsys.readouterr().out
