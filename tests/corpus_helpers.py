"""Data paths, the toy corpus and a directory writer shared by the tests."""

import os

SF = "/root/testdata"


def write_corpus(root, files: dict) -> str:
    """files: {"block/file": bytes or str}; a key ending in '/' makes an empty dir."""
    os.makedirs(root, exist_ok=True)
    for rel, data in files.items():
        path = os.path.join(root, rel)
        if rel.endswith("/"):
            os.makedirs(path, exist_ok=True)
            continue
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "wb") as fh:
            fh.write(data.encode() if isinstance(data, str) else data)
    return root


# The toy corpus and its golden query results (FIXTURES.md 1.1).
TOY = {
    "0/fine.txt": "i'm fine , thank you\n",
    "0/hello.txt": "hi hi\nhow are you ?\n",
    "1/bye.txt": "good to see you , bye\nsee you later ?\n",
    "1/byebye.txt": "bye\nbye\nbye\n",
    "2/fine.txt": "i'm fine , thank you\n",
    "2/hello.txt": "hi hi\nhow are you ?\n",
}
TOY_QUERIES = [(1, "hello"), (2, "bye"), (3, "you"), (4, "how are you"), (5, "how are you ?")]
TOY_GOLDEN = {
    1: ["no results found"],
    2: ["1/bye.txt", "1/byebye.txt"],
    3: ["0/fine.txt", "0/hello.txt", "1/bye.txt", "2/fine.txt", "2/hello.txt"],
    4: ["0/hello.txt", "2/hello.txt"],
    5: ["0/hello.txt", "2/hello.txt"],
}
