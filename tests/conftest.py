import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from folioloom.session import build_session, ship_package

    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-"),
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-")})
    session.sparkContext.setLogLevel("ERROR")
    ship_package(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def folder(spark):
    from folioloom.session import new_folder

    return new_folder(spark, "test")


@pytest.fixture(scope="session")
def word_pieces():
    """A small sub-word model, trained on a few words."""
    from tokenizers import Tokenizer, decoders, models, normalizers, pre_tokenizers, processors, trainers

    model = Tokenizer(models.WordPiece(unk_token="[UNK]"))
    model.normalizer = normalizers.BertNormalizer(lowercase=True)
    model.pre_tokenizer = pre_tokenizers.BertPreTokenizer()
    model.decoder = decoders.WordPiece()
    words = ["the river runs down to the sea and the town lies by the river"] * 5
    model.train_from_iterator(words, trainers.WordPieceTrainer(vocab_size=80, special_tokens=["[PAD]", "[UNK]", "[CLS]", "[SEP]"]))
    model.post_processor = processors.TemplateProcessing(single="[CLS] $A [SEP]", special_tokens=[("[CLS]", 2), ("[SEP]", 3)])
    return model
