import random

from dossier.operators import models, sampling


def test_pair_scorer(spark):
    draw = random.Random(1)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(200):
        job = draw.sample(vocabulary, 8)
        shared = draw.randint(0, 8)
        cv = job[:shared] + [f"z{draw.randrange(99)}" for _ in range(12)]
        rows.append((i, " ".join(cv), " ".join(job), shared / 8))
    df = spark.createDataFrame(rows, "id int, text_a string, text_b string, label double")
    train, val = sampling.split_exact(df, "id")
    model, log = models.select_model(train, val)
    assert log.count() == len(models.PENALTIES)
    assert max(r.spearman for r in log.collect()) > 0.9
    scored = models.score_pairs(model, val)
    assert scored.columns == ["id", "text_a", "text_b", "label", "predicted_score"]
    assert all(0 <= r.predicted_score <= 1 for r in scored.collect())


def test_field_tagger(spark):
    draw = random.Random(2)
    words = {"PHONE": ["555-1234", "555-9876"], "EMAIL": ["a@b.c", "d@e.f"], "SKILL": ["Java", "Excel", "SQL"]}
    rows = []
    for page in range(12):
        for pos in range(20):
            label = draw.choice(list(words))
            rows.append((f"p{page}", pos, draw.choice(words[label]), [10, 20, 30, 40], label))
    df = spark.createDataFrame(rows, "page string, pos int, text string, box array<int>, label string")
    described = models.token_features(df, "page", "pos", box="box")
    assert described.columns == [*df.columns, "features"]
    model = models.fit_field_tagger(described, list(words), iterations=10)
    tagged = models.tag_fields(model, described)
    right = tagged.filter("label = predicted").count()
    assert right / len(rows) > 0.95
