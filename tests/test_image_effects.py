"""Screens, bands, blocks, holes, stamps and stains on small arrays."""

import numpy as np
import pytest

from quire.operators import images


def page(h=48, w=64):
    y, x = np.mgrid[:h, :w]
    return np.where((y // 6) % 2 == 0, 230.0, 40.0) + (x % 5)


def rng():
    return np.random.default_rng(3)


def test_nothing_to_do_leaves_the_page():
    x = page()
    for name, options in (("halftone_screen", {"cell": 0}), ("halftone_screen", {"strength": 0}), ("scan_banding", {"period": 1}), ("scan_banding", {"amplitude": 0}), ("jpeg_blocks", {"passes": 0}), ("holes", {"count": 0}), ("stain", {"count": 0}), ("pattern_stamp", {"alpha": 0})):
        assert np.array_equal(images.ACTIONS[name](x, rng(), **options), x), name


def test_screen_mixes_by_strength():
    x = np.full((32, 32), 128.0)
    out = images.halftone_screen(x, rng(), 4, 45, 1.0)
    assert set(np.unique(out)) == {0.0, 255.0} and abs((out > 0).mean() - 0.5) < 0.1
    assert np.allclose(images.halftone_screen(x, rng(), 4, 45, 0.5), (x + out) / 2)


def test_bands_stay_within_their_amplitude():
    x = np.full((200, 40), 100.0)
    out = images.scan_banding(x, rng(), 20, 0.1)
    assert np.abs(out / x - 1).max() <= 0.1 + 1e-9 and np.allclose(out, out[:, :1]) and not np.allclose(images.scan_banding(x, rng(), 20, 0.1, 30.0)[:, 0], images.scan_banding(x, rng(), 20, 0.1, 30.0)[:, -1])


def test_blocks_lose_more_with_less_quality():
    x = page()
    assert np.allclose(images._WAVES @ images._WAVES.T, np.eye(8))
    loss = [np.abs(images.jpeg_blocks(x, rng(), q, 1) - x).mean() for q in (95, 60, 10)]
    assert loss[0] < loss[1] < loss[2] and images.jpeg_blocks(x, rng()).shape == x.shape
    flat = np.full((9, 17), 200.0)
    assert np.abs(images.jpeg_blocks(flat, rng(), 90, 1) - flat).max() <= 1


@pytest.mark.parametrize("place", images.PLACES)
def test_holes(place):
    x = np.full((120, 90), 250.0)
    out = images.holes(x, rng(), 3, place, 0.2, fill=0.0, shadow=2)
    gone = out == 0
    assert 0 < gone.mean() < 0.25 and (out <= 250).all() and ((out < 250) & ~gone).any()
    if place == "center":
        assert not gone[0].any() and not gone[-1].any()
    else:
        assert gone[0].any() or gone[-1].any() or gone[:, 0].any() or gone[:, -1].any()
    assert np.array_equal(out, images.holes(x, rng(), 3, place, 0.2, fill=0.0, shadow=2))
    assert images.holes(np.full((9, 9), 250.0), rng(), 2, place).shape == (9, 9)


def test_holes_elsewhere_are_refused():
    with pytest.raises(ValueError):
        images.holes(page(), rng(), place="nowhere")


def test_stamps_and_stains_darken():
    x = np.full((60, 60), 240.0)
    assert images.pattern_stamp(x, rng()).mean() < 240 and images.pattern_stamp(x, rng(), np.full((90, 90), 0.0), 1.0).max() == 0
    out = images.stain(x, rng(), 2, 0.5)
    assert (out <= x).all() and out.min() < 200


def test_chain_of_new_effects():
    out = images.applied(page(), [("holes", {"count": 1}), ("stain", {}), ("pattern_stamp", {}), ("jpeg_blocks", {"passes": 1}), ("scan_banding", {}), ("halftone_screen", {})], 7)
    assert out.shape == page().shape and 0 <= out.min() and out.max() <= 255
