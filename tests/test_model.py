import numpy as np
import pytest

from vestigo.operators import model


def test_weights_are_found_in_order(tmp_path, monkeypatch):
    good, small = tmp_path / "a.onnx", tmp_path / "b.onnx"
    good.write_bytes(b"x" * model.MIN_MODEL_BYTES)
    small.write_bytes(b"x")
    monkeypatch.setenv(model.ENVIRONMENT, str(good))
    assert model.resolve_model() == str(good)
    with pytest.raises(ValueError):
        model.resolve_model(str(small))
    with pytest.raises(FileNotFoundError):
        model.resolve_model(str(tmp_path / "none"))
    monkeypatch.delenv(model.ENVIRONMENT)
    with pytest.raises(FileNotFoundError):
        model.resolve_model()


def test_pictures_keep_their_level_and_order():
    flat = np.full((300, 200, 3), 77, np.uint8)
    assert (model.resize(flat) == 77).all() and model.preprocess(flat).shape == (1, 3, 640, 640)
    assert abs(model.preprocess(flat)[0, 0, 5, 5] - 77 / 255) < 1e-6
    ramp = np.repeat(np.linspace(0, 255, 1280).astype(np.uint8)[None, :, None], 900, 0).repeat(3, 2)
    got = model.resize(ramp)[10, :, 0].astype(int)
    assert (np.diff(got) >= -1).all() and abs(got[320] - 127) <= 2 and (model.resize(ramp, 900, 1280) == ramp).all()


def test_head_and_session():
    assert model.head_rows(np.zeros((1, 4, 10))).shape == (0, 5) and model.head_rows(np.zeros((2, 5, 10))).shape == (0, 5)
    raw = np.arange(30, dtype=np.float32).reshape(1, 6, 5)
    assert model.head_rows(raw)[1].tolist() == [1, 6, 11, 16, 21, 26]

    class Session:
        def get_inputs(self):
            return [type("Input", (), {"name": "images"})]

        def run(self, names, feed):
            assert feed["images"].shape == (1, 3, 640, 640)
            return [raw]

    detect = model.onnx_detector(lambda page, tile: np.zeros((8, 8, 3), np.uint8), Session)
    assert detect(b"page", None).shape == (5, 6)


def test_contact_sheets():
    from vestigo.operators import sheet
    from vestigo.sources.files import image_size

    pages = [np.full((40, 30, 3), k, np.uint8) for k in range(8)]
    got = sheet.compose(pages[:5])
    assert [sheet.columns(k) for k in (0, 1, 2, 4, 5, 6)] == [1, 1, 2, 2, 3, 3] and got.shape == (12 + 2 * 52, 12 + 3 * 42, 3)
    assert (got[12:52, 12:42] == 0).all() and (got[64:104, 54:84] == 4).all() and (got[64:104, 96:126] == 255).all()
    wide = sheet.compose([np.full((100, 2800, 3), 9, np.uint8)])
    assert wide.shape == (50 + 24, 1400 + 24, 3) and (wide[12:62, 12:1412] == 9).all()
    out = sheet.contact_sheet(lambda data, extension: pages)(b"x", ".pdf")
    assert image_size(out) == (12 + 3 * 42, 12 + 2 * 52) and b"6 de 8 paginas" in out
    with pytest.raises(ValueError):
        sheet.contact_sheet(lambda data, extension: [])(b"x", ".pdf")
