import zipfile
from types import SimpleNamespace

from failcast import deploy


def test_only_threads_of_the_driver_go_without_the_package(tmp_path, monkeypatch):
    sent = []
    make = lambda master, app: SimpleNamespace(sparkContext=SimpleNamespace(master=master, applicationId=app, addPyFile=sent.append))
    monkeypatch.chdir(deploy.ROOT)
    deploy.ship(make("local[4]", "a"))
    assert not sent
    for app, master in (("b", "local-cluster[2,1,512]"), ("c", "spark://host:7077")):
        deploy.ship(make(master, app))
        deploy.ship(make(master, app))
    assert len(sent) == 2
    monkeypatch.chdir(tmp_path)
    monkeypatch.setenv("PYTHONPATH", "")
    deploy.ship(make("local[4]", "d"))
    assert len(sent) == 3 and "failcast/schema.py" in zipfile.ZipFile(sent[-1]).namelist()
