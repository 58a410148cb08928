import numpy as np

from heddle.llm import quality


def test_latent_space_is_that_of_a_plain_decomposition():
    """The axes span what the leading right singular vectors do, and cosines in it are theirs."""
    chance = np.random.default_rng(3)
    left, _ = np.linalg.qr(chance.standard_normal((300, 40)))
    right, _ = np.linalg.qr(chance.standard_normal((120, 40)))
    rows = (left * (50 * 0.8 ** np.arange(40))) @ right.T
    axes = quality.leading_axes(rows, 10)
    _, sizes, whole = np.linalg.svd(rows, full_matrices=False)
    plain = whole[:10].T
    assert axes.shape == (120, 10) and np.allclose(axes.T @ axes, np.eye(10), atol=1e-8)
    assert np.allclose(np.linalg.svd(axes.T @ plain)[1], 1, atol=1e-6)
    assert np.allclose(np.linalg.norm(rows @ axes, axis=0), sizes[:10], rtol=1e-6)

    def cosines(basis):
        latent = rows @ basis
        latent /= np.linalg.norm(latent, axis=1, keepdims=True)
        return latent @ latent.T

    assert np.allclose(cosines(axes), cosines(plain), atol=1e-5)


def test_fewer_rows_than_axes():
    rows = np.random.default_rng(1).standard_normal((4, 30))
    axes = quality.leading_axes(rows, 10)
    assert axes.shape == (30, 4) and np.allclose(rows @ axes @ axes.T, rows, atol=1e-8)
