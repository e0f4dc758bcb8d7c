"""The jobs one after the other, from raw text to a saved model."""

from cardwatch.__main__ import main
from cardwatch.operators import model as ml
from cardwatch.plans.jobs import training_job

DAY = 86400


def test_jobs_from_text_to_model(spark, make, tmp_path):
    rows = make(
        [
            {
                "s": i * 7919 % (20 * DAY),
                "customer_id": i % 7,
                "terminal_id": i % 5,
                "tx_amount": float(i % 200),
            }
            for i in range(600)
        ]
    )
    raw, parquet, labelled, features, model = (
        str(tmp_path / name) for name in ("raw", "parquet", "labelled", "features", "model")
    )
    rows.write.csv(raw, timestampFormat="yyyy-MM-dd HH:mm:ss")
    main(["convert", "--inputs", raw, "--outputs", parquet])
    main(["label", "--inputs", parquet, "--outputs", labelled, "--seed", "3"])
    dates = ["--date_from", "2024-01-15", "--date_to", "2024-01-20"]
    main(["features", "--inputs", labelled, "--outputs", features, *dates])
    short = {"maxDepth": lambda r: 2, "numTrees": lambda r: r.randrange(2, 4)}
    record = training_job(
        spark, features, model, "2024-01-15", "2024-01-20", draws=2, folds=2, **short
    ).first()
    assert record["dataset_size"] == record["train_size"] + record["test_size"]
    assert record["dataset_size"] == rows.filter("tx_time_days between 14 and 19").count()
    assert record["maxDepth"] == 2
    assert 0 <= record["roc_auc"] <= 1 and 0 <= record["recall"] <= 1
    assert ml.best_parameters(ml.load_model(model))["numTrees"] == record["numTrees"]
