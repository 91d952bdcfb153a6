
import pytest



@pytest.fixture(scope="session")
def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path
